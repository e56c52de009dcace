"""Streaming job wiring: measures stream -> keyed windows -> foreachBatch upsert.

``emissions_stream`` is the stateful operator; ``start_rollup_query`` writes its output
to a :class:`~clockroll.sources.target.RollupTable` with batch-id idempotence (a batch
replayed after a failure is skipped).  One query may serve several granularities: the source is read
once and they share one state and one checkpoint.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.operators.aggregate import with_keys
from clockroll.operators.arrivals import Rules
from clockroll.operators.cadence import with_phases
from clockroll.operators.lateness import EMISSION_COLUMNS
from clockroll.session import scratch_dir, ship_package
from clockroll.sources.measures import MEASURE_COLUMNS, countable
from clockroll.sources.target import RollupTable, _exists
from clockroll.streaming.processor import STREAMED_DDL, WindowProcessor


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def emissions_stream(measures: DataFrame, cfgs: RollupConfig | list[RollupConfig], idle_timeout: bool = False) -> DataFrame:
    """Streaming measures -> emission rows (target columns + kind, phase) of one or several configurations, one per
    granularity; records that cannot be aggregated (foreign unit, no value, NaN, no object, no time) are left out here too.
    With ``idle_timeout`` the query needs a processing-time trigger (timers)."""
    spark = measures.sparkSession
    ship_package(spark)
    # keyed state with a value and a map per object needs a column-family state store
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    m = countable(measures).select(*MEASURE_COLUMNS)
    cfgs = [cfgs] if isinstance(cfgs, RollupConfig) else list(cfgs)
    if len({c.granularity for c in cfgs}) != len(cfgs) or not cfgs:
        raise ValueError("one configuration per granularity")
    proc = WindowProcessor([Rules.of(c) for c in cfgs], {c.granularity: c.timeout_ms for c in cfgs} if idle_timeout else None)
    out = m.groupBy("object_id").transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=STREAMED_DDL, outputMode="Append",
        timeMode="ProcessingTime" if idle_timeout else "None")
    return with_keys(out).select(*EMISSION_COLUMNS)


def start_rollup_query(spark: SparkSession, measures_stream: DataFrame, cfg: RollupConfig | list[RollupConfig],
                       table_path: str, checkpoint: str, trigger: dict | None = None,
                       idle_timeout: bool = False):
    """Start one query for one or several granularities (``merge`` and trigger interval must agree)."""
    cfgs = [cfg] if isinstance(cfg, RollupConfig) else list(cfg)
    if len({(c.merge, c.checkpoint_interval_ms) for c in cfgs}) != 1:
        raise ValueError("the granularities of a query share merge mode and checkpoint interval")
    cfg, names = cfgs[0], "+".join(str(c.granularity) for c in cfgs)
    table = RollupTable(spark, table_path, cfg.merge, writer=f"minutes={names}")
    em = emissions_stream(measures_stream, cfgs, idle_timeout)

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id)

    w = (em.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .queryName(f"clockroll_{names.replace('+', '_')}m_{crc32(table_path.encode())}"))
    w = w.trigger(**(trigger or {"processingTime": f"{cfg.checkpoint_interval_ms} milliseconds"}))
    return w.start()


def start_rejects_query(parsed_stream: DataFrame, path: str, checkpoint: str,
                        trigger: dict | None = None):
    """Rejected measures (``reason`` not NULL) to an append-only parquet table partitioned by
    reason -- a table instead of log lines; the file sink is exactly-once by its own log."""
    rej = parsed_stream.filter(F.col("reason").isNotNull())
    w = (rej.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).partitionBy("reason").outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def start_rollup_queries(spark: SparkSession, measures_stream: DataFrame,
                         cfgs: list[RollupConfig], table_path: str, checkpoint_root: str,
                         trigger: dict | None = None, idle_timeout: bool = False) -> list:
    """One streaming query per granularity, where they are to be stopped and changed apart (each reads the source
    again; ``start_rollup_query`` takes several in one).  All write to the same table: the target
    key contains ``minutes``, so the queries touch disjoint partitions."""
    if len({c.granularity for c in cfgs}) != len(cfgs):
        raise ValueError("one configuration per granularity")
    return [start_rollup_query(spark, measures_stream, c, table_path,
                               f"{checkpoint_root.rstrip('/')}/minutes={c.granularity}",
                               trigger, idle_timeout)
            for c in cfgs]


def _slices(spark: SparkSession, measures: DataFrame, slices: int) -> list[str]:
    """A recorded history as one folder per arrival range, earliest first (one write)."""
    root = scratch_dir(spark, "replay-history")
    m = measures.select(*MEASURE_COLUMNS)
    bounds = sorted(set(m.approxQuantile("arr_major", [i / slices for i in range(1, slices)], 0.01))) if slices > 1 else []
    part = F.lit(0)
    for b in bounds:
        part = part + F.when(F.col("arr_major") > F.lit(int(b)), 1).otherwise(0)
    m.withColumn("slice", part).write.partitionBy("slice").parquet(f"{root}/h")
    return [f"{root}/h/slice={i}" for i in range(len(bounds) + 1)]


def _replay(spark: SparkSession, measures: DataFrame, cfg: RollupConfig | list[RollupConfig], sink, slices: int) -> None:
    """Drive the streaming operator over a recorded history.  Each slice is delivered as a whole
    and is one micro-batch: the query is started once per slice, on one checkpoint, with no
    limit on files, so an object's records are never taken out of arrival order however many
    files a slice has.  A check of the stream; histories are computed by ``emissions``."""
    inbox, ckpt = scratch_dir(spark, "replay-inbox"), scratch_dir(spark, "replay-ckpt")
    schema = measures.select(*MEASURE_COLUMNS).schema
    # a replay's state partitions follow the cluster's parallelism (fixed at first start
    # of the query, recorded in its checkpoint); the session setting is restored after
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        for path in _slices(spark, measures, slices):
            # a slice without records has no folder
            if not _exists(spark, path):
                continue
            spark.read.schema(schema).parquet(path).write.mode("append").parquet(inbox)
            em = emissions_stream(spark.readStream.schema(schema).parquet(inbox), cfg)
            q = em.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
            q.awaitTermination()
    finally:
        spark.conf.set(key, old)


def replay_to_table(spark: SparkSession, measures: DataFrame, cfg: RollupConfig,
                    slices: int = 3, table_path: str | None = None) -> RollupTable:
    """Replay a recorded history through the stream into a rollup table.  Each replay is its
    own writer (its batch ids start at 0 with a fresh checkpoint)."""
    import uuid

    table = RollupTable(spark, table_path or scratch_dir(spark, "replay-table"), cfg.merge,
                        writer=f"replay-{uuid.uuid4().hex[:12]}")

    def sink(batch: DataFrame, batch_id: int) -> None:
        table.apply(batch, batch_id)

    _replay(spark, measures, cfg, sink, slices)
    return table


def replay_emissions(spark: SparkSession, measures: DataFrame, cfg: RollupConfig | list[RollupConfig], slices: int = 3) -> DataFrame:
    """Replay a recorded history through the stream; return all emissions, with phases over the
    whole history."""
    out = scratch_dir(spark, "replay-emissions")

    def sink(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch id: a retried batch overwrites its own output only
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _replay(spark, measures, cfg, sink, slices)
    raw = spark.read.parquet(out).drop("batch").withColumn("ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    return with_phases(raw).select(*EMISSION_COLUMNS)
