"""Window statistics against a list-based oracle (random values and gaps), and late merges
that must / must not move ``last``."""

import math
import random

from clockroll.operators.aggregate import rollup
from clockroll.operators.merge import upsert
from clockroll.sources.target import TARGET_SCHEMA

T0 = 1577876400000


def test_random_windows(spark):
    rnd = random.Random(7)
    recs, expect = [], {}
    for obj in range(30):
        n = rnd.randint(2, 300)
        ts = T0
        vals = []
        for i in range(n):
            v = rnd.random() * rnd.randint(0, 99)
            recs.append((obj, "V", ts, v, i, 0))
            vals.append((ts, v))
            ts += rnd.randint(100, 600)
        expect[obj] = vals
    df = spark.createDataFrame(recs, "object_id int, unit string, ts_ms long, value double, "
                                     "arr_major long, arr_minor long")
    got = {r["object_id"]: r for r in rollup(df, 60).collect()}
    for obj, vals in expect.items():
        r = got[obj]
        xs = [v for _, v in vals]
        n = len(xs)
        mean = sum(xs) / n
        std = math.sqrt(sum((x - mean) ** 2 for x in xs) / n)
        assert r["count"] == n
        assert math.isclose(r["sum"], sum(xs), rel_tol=1e-9)
        assert math.isclose(r["mean"], mean, rel_tol=1e-9)
        assert math.isclose(r["std"], std, rel_tol=1e-6, abs_tol=1e-9)
        assert r["min"] == min(xs) and r["max"] == max(xs)
        assert r["last"] == vals[-1][1] and r["last_ts"] == vals[-1][0]
        assert r["k"] == xs[0]
        assert math.isclose(r["k_sum"], sum(x - xs[0] for x in xs), rel_tol=1e-6, abs_tol=1e-6)
        assert math.isclose(r["k_sum_2"], sum((x - xs[0]) ** 2 for x in xs), rel_tol=1e-6)


def test_late_merge_moves_last_only_when_newer(spark):
    base = [(1, "V", T0 + 1000, 1.0, 0, 0), (1, "V", T0 + 2000, 2.0, 1, 0)]
    df = spark.createDataFrame(base, "object_id int, unit string, ts_ms long, value double, "
                                     "arr_major long, arr_minor long")
    stored = spark.createDataFrame(rollup(df, 15).collect(), TARGET_SCHEMA)

    def late(ts, v, seq):
        return (15, 1, "2020-01", stored.first()["timestamp"], 1, v, v, v, v, v, ts, v, 0.0, 0.0,
                0.0, "late", 0, seq, 0)

    cols = ("minutes int, object_id int, date string, timestamp timestamp_ntz, count long, "
            "sum double, min double, max double, mean double, last double, last_ts long, "
            "k double, k_sum double, k_sum_2 double, std double, kind string, phase int, "
            "arr_major long, arr_minor long")
    newer = spark.createDataFrame([late(T0 + 3000, 5.0, 10), late(T0 + 4000, 7.0, 11)], cols)
    r = upsert(stored, newer)[0].first()
    assert r["count"] == 4 and r["last"] == 7.0 and r["last_ts"] == T0 + 4000
    xs = [1.0, 2.0, 5.0, 7.0]
    m = sum(xs) / 4
    assert math.isclose(r["std"], math.sqrt(sum((x - m) ** 2 for x in xs) / 4), rel_tol=1e-9)
    older = spark.createDataFrame([late(T0 + 100, 9.0, 10), late(T0 + 200, -3.0, 11)], cols)
    r = upsert(stored, older)[0].first()
    assert r["count"] == 4 and r["last"] == 2.0 and r["min"] == -3.0 and r["max"] == 9.0


def test_last_tie_first_arrival_wins(spark):
    recs = [(1, "W", T0, 5.0, 3, 0), (1, "W", T0, 6.0, 1, 0), (1, "W", T0, 7.0, 2, 0)]
    df = spark.createDataFrame(recs, "object_id int, unit string, ts_ms long, value double, "
                                     "arr_major long, arr_minor long")
    r = rollup(df, 60).first()
    assert r["last"] == 6.0 and r["k"] == 6.0
