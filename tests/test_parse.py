import json

from clockroll.sources.measures import parse_measures


def _json(value, ts, unit="V", obj=1):
    return json.dumps({"objectId": obj, "value": value, "timestamp": ts, "unitSymbol": unit,
                       "type": "float", "comment": None, "unitName": "any", "owner": 1})


def _parse(spark, lines):
    df = spark.createDataFrame([(s, i, 0) for i, s in enumerate(lines)],
                               "value string, arr_major long, arr_minor long")
    return parse_measures(df).orderBy("arr_major").collect()


def test_good_measures(spark):
    cases = [("1.2", "2051-12-31T23:59:59Z", 2587679999000), ("-1.2", "2020-01-01T00:00:00Z", 1577836800000),
             ("0", "2020-01-01T00:00:00Z", 1577836800000), ("10", "2020-01-01Z", 1577836800000),
             ("0.233333333333", "2020-01-01T00:00Z", 1577836800000)]
    rows = _parse(spark, [_json(v, t) for v, t, _ in cases])
    for r, (v, _, ms) in zip(rows, cases):
        assert r["reason"] is None, r
        assert r["ts_ms"] == ms
        assert abs(r["value"] - float(v)) < 1e-6
        assert r["object_id"] == 1 and r["unit"] == "V"


def test_not_floats_dropped(spark):
    rows = _parse(spark, [_json(v, "2020-01-01T00:00:00Z") for v in
                          ["true", "false", "NaN", "", "on", "1.2.2", "nan", "inf", "-Infinity"]])
    reasons = [r["reason"] for r in rows]
    assert reasons[:6] == ["bad_value", "bad_value", "nan", "bad_value", "bad_value", "bad_value"]
    assert reasons[6:8] == ["bad_value", "bad_value"]  # Java spelling only
    assert reasons[8] is None and rows[8]["value"] == float("-inf")  # infinities are kept


def test_bad_timestamps_dropped(spark):
    bad = ["2020", "2020-31-12T10:00Z", "", "Z", "1900Z", "0000-00-00T00:00Z"]
    rows = _parse(spark, [_json("1.2", t) for t in bad])
    assert [r["reason"] for r in rows] == ["bad_timestamp"] * len(bad)


def test_unit_before_value_and_missing_fields(spark):
    lines = [_json("garbage", "2020-01-01T00:00:00Z", unit="kWh"),
             json.dumps({"objectId": 1, "value": "1.0", "unitSymbol": "V"}),
             json.dumps({"value": "1.0", "unitSymbol": "V", "timestamp": "2020-01-01Z"}),
             json.dumps({"objectId": "7", "value": "1.0", "unitSymbol": "V", "timestamp": "2020-01-01Z"}),
             "{not json", _json("1.5", "2020-01-01T00:00:00.123Z")]
    rows = _parse(spark, lines)
    assert [r["reason"] for r in rows] == ["unit", "missing_timestamp", "missing_object", None,
                                           "bad_json", None]
    assert rows[3]["object_id"] == 7
    assert rows[5]["ts_ms"] == 1577836800123


def test_json_history_files_in_name_order(spark, tmp_path):
    from clockroll.sources.measures import read_json_measures
    d = tmp_path / "hist"
    d.mkdir()
    (d / "2020-01-01T01.json").write_text(_json("2", "2020-01-01T01:00:00Z") + "\n" +
                                          _json("3", "2020-01-01T01:01:00Z") + "\n")
    (d / "2020-01-01T00.json").write_text(_json("1", "2020-01-01T00:00:00Z") + "\n")
    rows = read_json_measures(spark, str(d)).orderBy("arr_major", "arr_minor").collect()
    assert [r["value"] for r in rows] == [1.0, 2.0, 3.0]
    assert all(r["reason"] is None for r in rows)


def test_history_order_is_that_of_names_in_any_folder_with_equal_times(spark, tmp_path):
    import os
    files = [(n, [f"{n}:{i}" for i in range(k)]) for n, k in (("b.json", 3), ("a.json", 400), ("c.json", 1), ("d.json", 0), ("aa.json", 90))]
    want = [x for _, lines in sorted(files) for x in lines]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        # one split to a file, many splits to a file, many files to a task
        for k, size in enumerate(("128m", "300b", "64b")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            d = tmp_path / f"folder{k}"
            d.mkdir(parents=True)
            for name, lines in files:
                (d / name).write_text("".join(x + "\n" for x in lines))
                os.utime(d / name, (1_600_000_000, 1_600_000_000))
            from clockroll.sources.measures import numbered_lines
            rows = numbered_lines(spark, str(d)).collect()
            assert [r["value"] for r in sorted(rows, key=lambda r: (r["arr_major"], r["arr_minor"]))] == want
            assert sorted(r["arr_major"] + r["arr_minor"] for r in rows) == list(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_english_default_date_layout(spark):
    rows = _parse(spark, [_json("1.5", "Dec 19, 2016 12:00:00 AM"),
                          _json("1.5", "Jan 2, 2020 1:30:15 PM")])
    assert [r["reason"] for r in rows] == [None, None]
    assert rows[0]["ts_ms"] == 1482105600000 and rows[1]["ts_ms"] == 1577971815000


def test_object_id_forms(spark):
    ids = ["1", "1.0", "1e2", " 7 ", "1.5", "2147483648", "abc"]
    lines = [json.dumps({"objectId": i, "value": "1", "timestamp": "2020-01-01Z", "unitSymbol": "V"})
             for i in ids]
    lines.append('{"objectId": 3.0, "value": "1", "timestamp": "2020-01-01Z", "unitSymbol": "V"}')
    rows = _parse(spark, lines)
    assert [r["object_id"] for r in rows] == [1, 1, 100, 7, None, None, None, 3]
    assert [r["reason"] for r in rows][4:7] == ["bad_object_id"] * 3
