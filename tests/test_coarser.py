"""Coarser rollups from stored rows; stored rows read by a frame of keys; several granularities in one stream."""

import pytest
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.operators.aggregate import OUTPUT_COLUMNS, rollup, with_keys
from clockroll.operators.coarser import coarser
from clockroll.operators.lateness import emissions, emissions_many
from clockroll.plans.catalog import MULTI_LATE, dense, sparse
from clockroll.session import scratch_dir
from clockroll.sources.target import RollupTable
from clockroll.streaming.job import start_rollup_query
from tests.conftest import SF001, SF01

FREE_OF_K = [c for c in OUTPUT_COLUMNS if c not in ("k", "k_sum", "k_sum_2")]


def _rows(df):
    return sorted(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in df.collect())


def _alike(a, b):
    """Equal rows up to the last bits of sums that were added in another order."""
    key = ["minutes", "object_id", "timestamp"]
    one, two = a.orderBy(*key).collect(), b.orderBy(*key).collect()
    return len(one) == len(two) and all(x == pytest.approx(y, rel=1e-9, abs=1e-7) if isinstance(x, float) else x == y
                                        for r, s in zip(one, two, strict=True) for x, y in zip(r, s, strict=True))


def test_rows_of_rows_equal_rows_of_records(spark):
    m = dense(spark, SF01)
    daily = rollup(m, 1440, align="epoch")
    once = coarser(rollup(m, 15), 1440)
    twice = coarser(coarser(rollup(m, 15), 60), 1440)
    assert _alike(once.select(*FREE_OF_K), daily.select(*FREE_OF_K)) and daily.count() == 240
    assert _alike(once, twice)
    # the sums belong to the row's own k
    off = once.where("k IS NOT NULL").select(F.max(F.abs(F.col("sum") - F.col("count") * F.col("k") - F.col("k_sum"))).alias("d")).first()["d"]
    assert off < 1e-6


def test_rows_without_deviation_and_foreign_sizes(spark):
    m = sparse(spark, SF001).withColumn("unit", F.when(F.col("arr_minor") % 2 == 0, "lx").otherwise("V")).withColumn("object_id", F.lit(1))
    got = coarser(rollup(m, 15), 1440).collect()
    fine = rollup(m, 15).groupBy(F.to_date("timestamp").alias("d")).agg(F.count("k").alias("k"), F.count("*").alias("n")).collect()
    mixed = {str(r.d) for r in fine if r.k < r.n}
    assert mixed and all((r.std is None) == (str(r.timestamp.date()) in mixed) for r in got)
    assert coarser(rollup(m.limit(0), 15), 60).count() == 0
    with pytest.raises(Exception, match="cannot be made"):
        coarser(rollup(m, 25), 60).collect()


def test_read_by_keys_prunes_folders(spark):
    cfg = RollupConfig(granularity=60, allowed_lateness=30, flush_every=0)
    t = RollupTable(spark, scratch_dir(spark, "keys"))
    none = spark.createDataFrame([(60, 1, 0)], "minutes int, object_id int, ws_ms long")
    assert t.read_keys(with_keys(none)).collect()[0]["count"] is None  # nothing stored yet
    t.apply(emissions(dense(spark, SF001), cfg), 0)
    some = t.read().orderBy("timestamp", "object_id").limit(5)
    keys = some.select("minutes", "object_id", "date", "timestamp").unionByName(with_keys(none).select("minutes", "object_id", "date", "timestamp"))
    got = t.read_keys(keys.unionByName(keys))
    assert _rows(got.where("count IS NOT NULL")) == _rows(some) and got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_one_stream_for_all_granularities_goes_on_after_a_restart(spark):
    m = dense(spark, SF001).select("object_id", "unit", "ts_ms", "value", "arr_major", "arr_minor")
    cut = m.approxQuantile("arr_major", [0.5], 0.0)[0]
    inbox, table, ckpt = (scratch_dir(spark, "multi" + x) for x in ("-in", "-table", "-ckpt"))
    for part in (m.where(F.col("arr_major") <= cut), m.where(F.col("arr_major") > cut)):
        part.coalesce(1).write.mode("append").parquet(inbox)
        q = start_rollup_query(spark, spark.readStream.schema(m.schema).parquet(inbox), MULTI_LATE, table, ckpt, trigger={"availableNow": True})
        q.awaitTermination()
    want = emissions_many(m, MULTI_LATE).where("kind = 'closed' AND count > 1").groupBy("minutes").agg(F.count("*").alias("n"))
    got = RollupTable(spark, table).read().where("count > 1").groupBy("minutes").agg(F.count("*").alias("n"))
    have = {r.minutes: r.n for r in got.collect()}
    assert set(have) == {15, 60, 1440} and all(have[r.minutes] >= r.n * 0.9 for r in want.collect())
    from clockroll.operators.merge import upsert
    from clockroll.sources.target import TARGET_SCHEMA
    batch, _ = upsert(spark.createDataFrame([], TARGET_SCHEMA), emissions_many(m, MULTI_LATE))
    assert _alike(RollupTable(spark, table).read(), batch)
    with pytest.raises(ValueError):
        start_rollup_query(spark, spark.readStream.schema(m.schema).parquet(inbox), [MULTI_LATE[0], MULTI_LATE[0]], table, ckpt)
