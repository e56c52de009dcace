import datetime as dt

from pyspark.sql import functions as F

from clockroll.functions.timefn import date_key, format_ts, ntz_from_ms, window_start_ms
from clockroll.functions.units import is_target_unit, with_stdev

WINDOW_VECTORS = [(1577876400000, 1577876400000), (1577876400010, 1577876400000),
                  (1577876401000, 1577876400000), (1577877299999, 1577876400000)]
DATE_VECTORS = [(1577836800000, "2020-01", "2020-01"), (1586307553010, "2020-04", "2020-01"),
                (1592107980000, "2020-06", "2020-01"), (1596232800000, "2020-07", "2020-12"),
                (2587679999000, "2051-12", "2051-12")]


def test_window_start_vectors(spark):
    df = spark.createDataFrame([(a,) for a, _ in WINDOW_VECTORS], "ts long")
    got = [r[0] for r in df.select(window_start_ms(F.col("ts"), 15)).collect()]
    assert got == [b for _, b in WINDOW_VECTORS]


def test_window_start_odd_granularities(spark):
    # 11:55 -> 11:50 for 25 minutes, 11:00 for 90 and 1440 (hour-aligned)
    t = int(dt.datetime(2020, 1, 1, 11, 55, 30, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = spark.createDataFrame([(t,)], "ts long")
    row = df.select(window_start_ms(F.col("ts"), 25), window_start_ms(F.col("ts"), 90),
                    window_start_ms(F.col("ts"), 1440),
                    window_start_ms(F.col("ts"), 1440, "epoch")).collect()[0]
    h11 = int(dt.datetime(2020, 1, 1, 11, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert row[0] == h11 + 50 * 60000
    assert row[1] == h11 and row[2] == h11
    assert row[3] == int(dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_date_key_vectors(spark):
    df = spark.createDataFrame([(a,) for a, _, _ in DATE_VECTORS], "ts long")
    for g, idx in ((15, 1), (60, 1), (1440, 2)):
        got = [r[0] for r in df.select(date_key(window_start_ms(F.col("ts"), g), g)).collect()]
        assert got == [v[idx] for v in DATE_VECTORS], g


def test_format_and_ntz(spark):
    df = spark.createDataFrame([(1577836800000,), (None,)], "ts long")
    rows = df.select(format_ts(F.col("ts")), ntz_from_ms(F.col("ts"))).collect()
    assert rows[0][0] == "2020-01-01T00:00:00Z" and rows[1][0] == "null"
    assert rows[0][1] == dt.datetime(2020, 1, 1)


def test_units(spark):
    units = ["lx", "m/s", "%", "A", "ppm", "V", "W", "°C", "kWh", "v", None]
    df = spark.createDataFrame([(u,) for u in units], "u string")
    rows = df.select(is_target_unit(F.col("u")), with_stdev(F.col("u"))).collect()
    assert [r[0] for r in rows] == [True] * 8 + [False] * 3
    assert [r[1] for r in rows] == [False, False] + [True] * 6 + [False] * 3
