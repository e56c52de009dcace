"""Stream replay equals the batch form; target batch ids are applied once."""

import math

from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.operators.lateness import emissions
from clockroll.operators.merge import upsert
from clockroll.plans.catalog import dense
from clockroll.session import scratch_dir
from clockroll.sources.target import TARGET_SCHEMA, RollupTable
from clockroll.streaming.job import replay_emissions, replay_to_table
from tests.conftest import SF001, SF01

CFG = RollupConfig(granularity=60, allowed_lateness=30, flush_every=0)


def _rows(df):
    return sorted(tuple(None if isinstance(x, float) and math.isnan(x) else
                        (round(x, 6) if isinstance(x, float) else x) for x in r)
                  for r in df.collect())


def test_stream_equals_batch(spark):
    m = dense(spark, SF001)
    table = replay_to_table(spark, m, CFG, slices=3)
    assert all(table.applied(i) for i in range(3))  # 3 micro-batches
    batch_rows, _ = upsert(spark.createDataFrame([], TARGET_SCHEMA), emissions(m, CFG))
    assert _rows(table.read()) == _rows(batch_rows)


def test_stream_emissions_equal_batch_one_slice(spark):
    m = dense(spark, SF001)
    em = replay_emissions(spark, m, CFG, slices=1)
    want = emissions(m, CFG)
    cols = ["object_id", "timestamp", "kind", "phase", "count", "sum", "last", "last_ts", "k"]
    assert _rows(em.select(*cols)) == _rows(want.select(*cols))


def test_table_batch_idempotent(spark):
    m = dense(spark, SF001)
    em = emissions(m, CFG)
    t = RollupTable(spark, scratch_dir(spark, "t"))
    a1 = t.apply(em, 0)
    n1 = t.read().count()
    a2 = t.apply(em, 0)  # same batch id again: skipped
    assert a1 == a2 and t.read().count() == n1
    assert a1["rec_normal"] + a1["rec_override"] + a1["rec_skip"] == em.filter("kind='closed'").count()
    a3 = t.apply(em, 1)  # a real replay: closed skipped, late merged again
    assert a3["rec_skip"] + a3["rec_override"] == em.filter("kind='closed'").count()
    assert t.read().count() == n1
    assert t.read().agg(F.sum("count")).collect()[0][0] > 0


def test_stream_cadence_equals_fold(spark):
    """flush_every > 0 (default 2 min): the stream operator over 3 micro-batches must equal the
    definition."""
    from tests.reference_fold import fold_emissions
    cfg = RollupConfig(granularity=60, allowed_lateness=30)  # flush_every 2
    m = dense(spark, SF001)
    recs = [tuple(r) for r in m.select("object_id", "unit", "ts_ms", "value", "arr_major",
                                       "arr_minor").collect()]
    want = fold_emissions(recs, 60, 30, 2)
    em = replay_emissions(spark, m, cfg, slices=3)
    got = em.withColumn(
        "ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    cols = ["object_id", "ws_ms", "kind", "phase", "count", "sum", "last_ts", "k"]

    def canon(rows):
        return sorted((*r[:5], round(r[5], 6), r[6], None if r[7] is None else round(r[7], 6)) for r in rows)

    want_rows = canon([(*e[:5], e[5], e[10], e[11]) for e in want])
    assert canon(got.select(*cols).collect()) == want_rows
    batch = emissions(m, cfg).withColumn("ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    assert canon(batch.select(*cols).collect()) == want_rows


def test_slices_of_several_files(spark):
    """Files of one slice interleave in arrival: the slice must still be one micro-batch."""
    m = dense(spark, SF01).repartition(4)
    em = replay_emissions(spark, m, CFG, slices=1)
    assert {r["kind"]: r["count"] for r in em.groupBy("kind").count().collect()} == {"closed": 4078, "late": 492}
    three = replay_emissions(spark, m, CFG, slices=3)
    cols = ["object_id", "timestamp", "kind", "phase", "count", "sum", "last", "last_ts", "k"]
    assert _rows(three.select(*cols)) == _rows(em.select(*cols)) == _rows(emissions(m, CFG).select(*cols))


def test_records_that_cannot_be_counted_are_left_out_of_the_stream(spark):
    t0 = 1577876400000
    rows = [(1, "V", t0, 1.0, 0, 0), (1, "V", t0 + 1000, float("nan"), 1, 0), (1, "V", t0 + 2000, 3.0, 2, 0),
            (1, "V", None, 9.0, 3, 0), (None, "V", t0, 9.0, 4, 0), (1, "V", t0, None, 5, 0), (1, "kWh", t0, 9.0, 6, 0),
            (1, "V", t0 + 40 * 60_000, 7.0, 7, 0)]
    m = spark.createDataFrame(rows, "object_id int, unit string, ts_ms long, value double, arr_major long, arr_minor long")
    got = replay_emissions(spark, m, RollupConfig(granularity=15, allowed_lateness=5, flush_every=0), slices=1).collect()
    assert [(r["kind"], r["count"], r["sum"], r["k_sum"], r["std"]) for r in got] == [("closed", 2, 4.0, 2.0, 1.0)]


def test_restart_continues_from_the_checkpoint(spark):
    """A query stopped between files and started again gives the rows of one uninterrupted run."""
    from clockroll.streaming.job import start_rollup_queries
    cfgs = [CFG, RollupConfig(granularity=15, allowed_lateness=5)]
    m = dense(spark, SF001).select("object_id", "unit", "ts_ms", "value", "arr_major", "arr_minor")
    cut = m.approxQuantile("arr_major", [0.5], 0.0)[0]

    def run(path, parts):
        inbox, table, ckpt = (scratch_dir(spark, path + x) for x in ("-in", "-table", "-ckpt"))
        for part in parts:
            part.coalesce(1).write.mode("append").parquet(inbox)
            stream = spark.readStream.schema(m.schema).parquet(inbox)
            for q in start_rollup_queries(spark, stream, cfgs, table, ckpt, trigger={"availableNow": True}):
                q.awaitTermination()
        return RollupTable(spark, table).read()

    once = run("one", [m])
    twice = run("two", [m.where(F.col("arr_major") <= cut), m.where(F.col("arr_major") > cut)])
    assert _rows(once) == _rows(twice) and once.count() > 0


def test_two_writers_share_a_table(spark):
    """One query per granularity writes to the same table with the same batch ids."""
    from clockroll.operators.lateness import emissions
    m = dense(spark, SF001)
    c15 = RollupConfig(granularity=15, allowed_lateness=5, flush_every=0)
    path = scratch_dir(spark, "shared")
    a = RollupTable(spark, path, writer="minutes=60").apply(emissions(m, CFG), 0)
    b = RollupTable(spark, path, writer="minutes=15").apply(emissions(m, c15), 0)
    assert a["rec_normal"] > 0 and b["rec_normal"] > 0
    got = {r["minutes"]: r["n"] for r in RollupTable(spark, path).read()
           .groupBy("minutes").agg(F.count("*").alias("n")).collect()}
    assert set(got) == {15, 60}


def test_table_combine_mode(spark):
    """merge='combine': every emitted value lands in its row exactly once per applied batch;
    a replayed batch id is still skipped."""
    from clockroll.operators.lateness import emissions
    m = dense(spark, SF001)
    em = emissions(m, CFG)
    emitted_values = em.agg(F.sum("count")).collect()[0][0]
    t = RollupTable(spark, scratch_dir(spark, "comb"), merge="combine")
    t.apply(em, 0)
    assert t.read().agg(F.sum("count")).collect()[0][0] == emitted_values
    t.apply(em, 0)  # same batch id: skipped
    assert t.read().agg(F.sum("count")).collect()[0][0] == emitted_values
    t.apply(em, 1)  # a new batch with the same emissions: combined, values counted twice
    assert t.read().agg(F.sum("count")).collect()[0][0] == 2 * emitted_values
