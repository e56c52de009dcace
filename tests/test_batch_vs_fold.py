"""Batch (DataFrame) lateness/emissions/upsert against the record-by-record fold, on random
arrivals with several objects, bursts and reordering."""

import math
import random

import pytest
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.operators.lateness import emissions
from clockroll.operators.merge import action_totals, upsert, upsert_combine
from clockroll.sources.target import TARGET_SCHEMA
from tests.reference_fold import fold_emissions, sink_apply

UNITS = ["V", "lx", "W", "m/s", "%"]
T0 = 1704067200000


def random_records(seed, n=600, objects=4, ties=False):
    rnd = random.Random(seed)
    recs = []
    for i in range(n):
        obj = rnd.randrange(objects)
        ts = T0 + rnd.randrange(0, 6 * 3600_000)
        if ties:
            ts -= ts % 60_000
        delay = rnd.choice([0, 0, 0, rnd.randrange(0, 3 * 3600_000)])
        unit = UNITS[obj % len(UNITS)]
        v = round(rnd.uniform(-50, 150), 2)
        recs.append((obj, unit, ts, v, (ts + delay) * 1000, i))
    return recs


def to_df(spark, recs):
    return spark.createDataFrame(recs, "object_id int, unit string, ts_ms long, value double, "
                                       "arr_major long, arr_minor long")


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-6)


def _key(e):
    return (e[0], e[1], e[2], e[3], e[4])


@pytest.mark.parametrize("seed,g,lat,parts,batch", [
    (1, 15, 5, 4, 10_000), (2, 60, 30, 4, 10_000), (3, 25, 0, 1, 10_000), (4, 1440, 10, 4, 10_000),
    # many ranges and tiny batches: objects go on across tasks and across batches
    (7, 60, 30, 40, 7), (8, 15, 5, 25, 3)])
def test_emissions_match_fold(spark, seed, g, lat, parts, batch):
    recs = random_records(seed, ties=seed % 2 == 0)
    cfg = RollupConfig(granularity=g, allowed_lateness=lat, flush_every=0)
    want = fold_emissions(recs, g, lat, 0)
    keys = {"spark.sql.shuffle.partitions": parts, "spark.sql.execution.arrow.maxRecordsPerBatch": batch}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, str(v))
    em = emissions(to_df(spark, recs), cfg)
    for k, v in old.items():
        spark.conf.set(k, v)
    got = (em.withColumn("ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
           .select("object_id", "ws_ms", "kind", "phase", "count", "sum", "min", "max", "mean",
                   "last", "last_ts", "k", "k_sum", "k_sum_2", "std", "arr_major", "arr_minor")
           .collect())
    want_s = sorted(want, key=lambda e: (e[0], e[1], e[3], e[15] or 0, e[16] or 0))
    got_s = sorted([tuple(r) for r in got], key=lambda e: (e[0], e[1], e[3], e[15] or 0, e[16] or 0))
    assert len(got_s) == len(want_s)
    for a, b in zip(got_s, want_s):
        assert _key(a) == _key(b), (a, b)
        for i in range(5, 15):
            assert close(a[i], b[i]), (i, a, b)


@pytest.mark.parametrize("seed", [5, 6])
def test_upsert_matches_sink(spark, seed):
    recs = random_records(seed, n=800, objects=3)
    cfg = RollupConfig(granularity=60, allowed_lateness=20, flush_every=0)
    want_table = {}
    want_acts = sink_apply(want_table, fold_emissions(recs, 60, 20, 0))
    empty = spark.createDataFrame([], TARGET_SCHEMA)
    rows, acts = upsert(empty, emissions(to_df(spark, recs), cfg))
    got = {(r["object_id"], r["ws"]): r for r in
           rows.withColumn("ws", F.unix_millis(F.col("timestamp").cast("timestamp"))).collect()}
    assert set(got) == set(want_table)
    for key, w in want_table.items():
        r = got[key]
        for c in ["count", "sum", "min", "max", "mean", "last", "last_ts", "k", "k_sum", "k_sum_2", "std"]:
            assert close(r[c], w[c]), (key, c, r[c], w[c])
    tot = action_totals(acts).collect()[0].asDict()
    assert tot == want_acts


def test_replay_and_combine(spark):
    """Applying the same emissions twice: closed ones are skipped (idempotent), late ones
    are merged again (the sink is a plain read-then-write).  Combine keeps every value."""
    recs = random_records(9, n=500, objects=2)
    cfg = RollupConfig(granularity=60, allowed_lateness=20, flush_every=0)
    em = emissions(to_df(spark, recs), cfg)
    empty = spark.createDataFrame([], TARGET_SCHEMA)
    first, _ = upsert(empty, em)
    second, acts = upsert(spark.createDataFrame(first.collect(), TARGET_SCHEMA), em)
    tot = action_totals(acts).collect()[0].asDict()
    n_closed = em.filter("kind = 'closed'").count()
    n_late = em.filter("kind = 'late'").count()
    assert tot["rec_late_update"] == n_late and tot["rec_late_first"] == 0
    assert tot["rec_override"] + tot["rec_skip"] == n_closed and tot["rec_override"] == 0
    comb, _ = upsert_combine(empty, em)
    total = comb.agg(F.sum("count")).collect()[0][0]
    assert total == em.agg(F.sum("count")).collect()[0][0]


@pytest.mark.parametrize("flush_end", [False, True])
@pytest.mark.parametrize("seed,g,lat,fe", [(11, 60, 30, 2), (12, 15, 5, 7), (13, 1440, 60, 30)])
def test_cadence_matches_fold(spark, seed, g, lat, fe, flush_end):
    """One pass over sorted records, in Arrow batches far smaller than an object's history."""
    recs = random_records(seed, n=700, objects=3)
    key, old = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "37")
    try:
        got = emissions(to_df(spark, recs), RollupConfig(granularity=g, allowed_lateness=lat, flush_every=fe), flush_at_end=flush_end)
        got = got.withColumn("ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp"))).select(
            "object_id", "ws_ms", "kind", "phase", "count", "sum", "min", "max", "mean", "last", "last_ts", "k", "k_sum", "k_sum_2", "std", "arr_major", "arr_minor").collect()
    finally:
        spark.conf.set(key, old)
    order = lambda e: (e[0], e[1], e[3], e[15] or 0, e[16] or 0)
    want = sorted(fold_emissions(recs, g, lat, fe, flush_end=flush_end), key=order)
    got = sorted(map(tuple, got), key=order)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert _key(a) == _key(b), (a, b)
        for i in range(5, 15):
            assert close(a[i], b[i]), (i, a, b)
