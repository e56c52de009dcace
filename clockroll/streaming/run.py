"""The job: a properties file -> source, parser, windows, target, rejects and counters.

``python -m clockroll.streaming.run job.properties`` (or ``run_job`` from a session) starts the
queries and waits for them.  Keys: the window options; ``source.format`` (``kafka`` with
``kafka.brokers``, ``kafka.augmentation``, ``kafka.consumer.group``; or ``json`` with ``source.path``, a folder of
JSON-lines files, each a delivery that one task can hold); ``target.path``; ``checkpoint.path``; optional ``rejects.path``.  Entry points and
consistency levels belong to a database target and have no meaning for a table on a file
system: they are checked, and a job that sets them is refused unless they are the defaults.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clockroll.config import DEFAULT_CONSISTENCY, ConfigError, RollupConfig
from clockroll.metrics import observe_parse
from clockroll.sources.measures import parse_measures, read_kafka_measures
from clockroll.streaming.job import start_rejects_query, start_rollup_query


def parsed_source(spark: SparkSession, cfg: RollupConfig) -> DataFrame:
    """The stream of parsed records (with ``reason``) that ``cfg`` names."""
    if cfg.source_format == "kafka":
        return read_kafka_measures(spark, cfg.bootstrap_servers, cfg.topic, cfg.consumer_group)
    # A stream has no row numbers: a file is read as one text and split, each line with its place.
    files = spark.readStream.option("wholetext", "true").text(cfg.source_path)
    name = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 23)) * F.lit(1 << 40)
    lines = files.select(F.unix_micros("_metadata.file_modification_time").alias("arr_major"), name.alias("name"), F.posexplode(F.split("value", "\n")).alias("at", "value"))
    return parse_measures(lines.where("value <> ''").select("value", "arr_major", (F.col("name") + F.col("at")).alias("arr_minor")))


def start_job(spark: SparkSession, cfg: RollupConfig, rejects_path: str | None = None, trigger: dict | None = None,
              idle_timeout: bool = True) -> list[StreamingQuery]:
    """Start the job's queries; stopped and started again they go on from ``checkpoint.path``."""
    cfg.require_job()
    if cfg.entrypoints or cfg.consistency != DEFAULT_CONSISTENCY:
        raise ConfigError("entry points and consistency levels do not apply to a table target")
    root = cfg.checkpoint_path.rstrip("/")
    counted, _ = observe_parse(parsed_source(spark, cfg), f"parse_{cfg.granularity}m")
    out = [start_rollup_query(spark, counted, cfg, cfg.target_path, f"{root}/minutes={cfg.granularity}", trigger, idle_timeout)]
    if rejects_path:
        out.append(start_rejects_query(parsed_source(spark, cfg), rejects_path, f"{root}/rejects", trigger))
    return out


def run_job(spark: SparkSession, properties: str, rejects_path: str | None = None) -> None:
    """Run the job of a properties file until it is stopped."""
    for q in start_job(spark, RollupConfig.from_properties(properties), rejects_path):
        q.awaitTermination()


if __name__ == "__main__":
    from clockroll.session import ensure_utc

    run_job(ensure_utc(SparkSession.builder.appName("clockroll").getOrCreate()), *sys.argv[1:3])
