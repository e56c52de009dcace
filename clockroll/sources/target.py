"""The rollup target: a parquet table partitioned by (minutes, date, day, bucket), upserted per batch.

``day`` (days since the epoch of the window start) and ``bucket`` (a hash of the object) are
physical sub-partitions derived from the key, invisible to readers: a micro-batch touches
the last day or two (closed windows) plus a few older days (late records), and of an older
day only the buckets of the late objects, so it rewrites those only.  Rows lie by object,
newest window first.  A granularity has one writer; a second one is refused.

One batch = emissions of one micro-batch or one batch run, identified by ``batch_id``.
Apply steps (each repeatable after a lost executor or a driver restart):

1. skip if ``_batches/<writer>/batch=<id>`` exists (already applied);
2. read only the touched partitions of the table (partition pruning), fold the
   emissions into them, and write the new content of those partitions to
   ``_staging/<writer>/batch=<id>`` (lineage cut; reading and overwriting one path in one plan
   is never done);
3. dynamic-overwrite the touched partitions from the staged copy;
4. write the batch marker (with the action counters), then delete the staged files.

A retry after step 2 reuses the complete staged copy instead of folding again, so a late
record is never merged twice.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clockroll.operators.aggregate import OUTPUT_COLUMNS
from clockroll.operators.merge import ACTION_COLUMNS, KEY, action_totals, upsert, upsert_combine

TARGET_SCHEMA = T.StructType([
    T.StructField("minutes", T.IntegerType()),
    T.StructField("object_id", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("count", T.LongType()),
    T.StructField("sum", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("last", T.DoubleType()),
    T.StructField("last_ts", T.LongType()),
    T.StructField("k", T.DoubleType()),
    T.StructField("k_sum", T.DoubleType()),
    T.StructField("k_sum_2", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
])
assert [f.name for f in TARGET_SCHEMA.fields] == OUTPUT_COLUMNS
#: Keys that a read may broadcast.
BROADCAST_KEYS = 500_000
PARTITIONS = ["minutes", "date", "day", "bucket"]
#: Fixed part of the layout of every table.
BUCKETS = 8
STORED_SCHEMA = T.StructType(TARGET_SCHEMA.fields + [T.StructField("day", T.IntegerType()), T.StructField("bucket", T.IntegerType())])


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumns({"day": F.unix_date(F.col("timestamp").cast("date")), "bucket": F.pmod(F.hash("object_id"), F.lit(BUCKETS))})


def _laid_out(df: DataFrame) -> DataFrame:
    """Rows of a partition together, large ones over several tasks, newest windows first."""
    return _with_day(df).hint("rebalance", *PARTITIONS).sortWithinPartitions(*PARTITIONS, "object_id", F.desc("timestamp"))


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.text(path).collect())


class RollupTable:
    """Parquet rollup table; ``merge`` = "parity" (default) or "combine".

    ``writer`` names the producer of the batch ids (e.g. one stream query per granularity):
    batch markers and staged files live under it, so writers sharing a table never mistake
    each other's batch ids."""

    def __init__(self, spark: SparkSession, path: str, merge: str = "parity",
                 writer: str = "default"):
        if merge not in ("parity", "combine"):
            raise ValueError("merge must be 'parity' or 'combine'")
        self.spark, self.path, self.merge = spark, path.rstrip("/"), merge
        self.writer = writer

    # -- reading ------------------------------------------------------------
    def read(self) -> DataFrame:
        """All rows, in no particular order."""
        if not _exists(self.spark, self.path + "/_SUCCESS") and not self._has_data():
            return self.spark.createDataFrame([], TARGET_SCHEMA)
        df = self.spark.read.schema(STORED_SCHEMA).parquet(self.path)
        return df.select(*OUTPUT_COLUMNS)

    def newest_first(self, minutes: int, object_id: int, date: str) -> DataFrame:
        """The rows of one (granularity, object, date key), newest window first."""
        own = (F.col("minutes") == minutes) & (F.col("date") == date) & (F.col("object_id") == object_id)
        return self.read().where(own).orderBy(F.desc("timestamp"))

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The stored row of each of ``keys`` (the four columns of ``KEY``); keys without one have NULL statistics.

        The partition folders follow from the key, so they are join columns too.  With keys small
        enough to be broadcast only the folders they name are read (dynamic partition pruning);
        with more the join is shuffled."""
        asked = _with_day(keys.select(*KEY).distinct()).where("minutes > 0")
        stored = self.spark.read.schema(STORED_SCHEMA).parquet(self.path) if self._has_data() else self.spark.createDataFrame([], STORED_SCHEMA)
        if asked.count() <= BROADCAST_KEYS:
            asked = F.broadcast(asked)
        found = stored.join(asked, [*KEY, "day", "bucket"]).select(*OUTPUT_COLUMNS)
        return keys.select(*KEY).distinct().join(found, KEY, "left").select(*OUTPUT_COLUMNS)

    def total_actions(self) -> dict:
        """The action counters of all batches that this writer has applied."""
        path = f"{self.path}/_batches/{self.writer}"
        if not _exists(self.spark, path):
            return {c: 0 for c in ACTION_COLUMNS}
        kinds = ", ".join(f"{c} long" for c in ACTION_COLUMNS)
        acts = self.spark.read.text(path).select(F.from_json("value", kinds).alias("a")).select("a.*")
        return {c: int(v or 0) for c, v in action_totals(acts).first().asDict().items()}

    def _has_data(self) -> bool:
        fs, p, jvm = _hadoop_fs(self.spark, self.path)
        if not fs.exists(p):
            return False
        return any(not s.getPath().getName().startswith(("_", "."))
                   for s in fs.listStatus(p))

    def _marker(self, batch_id: int) -> str:
        return f"{self.path}/_batches/{self.writer}/batch={int(batch_id)}"

    def _staging(self) -> str:
        return f"{self.path}/_staging/{self.writer}"

    def applied(self, batch_id: int) -> bool:
        return _exists(self.spark, self._marker(batch_id))

    def batch_actions(self, batch_id: int) -> dict:
        return json.loads(_read_text(self.spark, self._marker(batch_id)))

    def _read_partitions(self, parts: list) -> DataFrame:
        """Stored rows of the given partitions.  Only those folders are
        listed (``basePath`` keeps the partition columns), not the whole table, so the
        cost of a micro-batch does not grow with the table's history."""
        import re

        plain = re.compile(r"^[0-9A-Za-z_-]+$")
        if not all(plain.match(str(v)) for part in parts for v in part):
            cond = None  # unusual partition values: let Spark's own escaping handle them
            for values in parts:
                c = F.lit(True)
                for name, v in zip(PARTITIONS, values, strict=True):
                    c = c & (F.col(name) == F.lit(v))
                cond = c if cond is None else (cond | c)
            return (self.spark.read.schema(STORED_SCHEMA).parquet(self.path)
                    .filter(cond).select(*OUTPUT_COLUMNS))
        paths = ["/".join([self.path, *(f"{n}={v}" for n, v in zip(PARTITIONS, values, strict=True))]) for values in parts]
        paths = [p for p in paths if _exists(self.spark, p)]
        if not paths:
            return self.spark.createDataFrame([], TARGET_SCHEMA)
        return (self.spark.read.option("basePath", self.path).schema(STORED_SCHEMA)
                .parquet(*paths).select(*OUTPUT_COLUMNS))

    # -- writing ------------------------------------------------------------
    def apply(self, emitted: DataFrame, batch_id: int) -> dict:
        """Upsert one batch of emissions; returns the action counters of that batch."""
        if self.applied(batch_id):
            return self.batch_actions(batch_id)
        b = int(batch_id)
        stage = f"{self._staging()}/batch={b}"
        fold_path = f"{self._staging()}/fold-{b}"
        had_data = self._has_data()
        totals = None
        if not _exists(self.spark, stage + "/_SUCCESS"):
            # 1. the batch's emissions, computed once (a stream batch is not recomputed);
            #    the touched partitions (granularities x days: a small set) are observed
            #    during that write instead of by a separate job
            em_path = f"{self._staging()}/emissions-{b}"
            touched = None
            if not _exists(self.spark, em_path + "/_SUCCESS"):
                obs = Observation(f"touched-{b}")
                (_with_day(emitted).observe(obs, F.collect_set(F.struct(*PARTITIONS)).alias("t"))
                 .drop("day", "bucket").write.mode("overwrite").parquet(em_path))
                touched = [tuple(r[c] for c in PARTITIONS) for r in obs.get["t"]]
            em = _with_day(self.spark.read.parquet(em_path))
            if touched is None:  # retry: read the staged emissions
                touched = [tuple(r) for r in em.select(*PARTITIONS).distinct().collect()]
            if not touched:
                totals = {c: 0 for c in ACTION_COLUMNS}
                _write_text(self.spark, self._marker(b), json.dumps(totals))
                self._unstage(b)
                return totals
            self._own({t[0] for t in touched})
            existing = self._read_partitions(touched) if had_data else \
                self.spark.createDataFrame([], TARGET_SCHEMA)
            # 3. fold once; rows and per-key actions stay together; totals observed
            if not _exists(self.spark, fold_path + "/_SUCCESS"):
                fold = upsert if self.merge == "parity" else upsert_combine
                rows, actions = fold(existing, em.drop("day", "bucket"))
                obs = Observation(f"actions-{b}")
                (rows.join(actions, KEY)
                 .observe(obs, *[F.sum(c).cast("long").alias(c) for c in ACTION_COLUMNS])
                 .write.mode("overwrite").parquet(fold_path))
                totals = {c: int(obs.get[c] or 0) for c in ACTION_COLUMNS}
                _write_text(self.spark, f"{self._staging()}/actions-{b}", json.dumps(totals))
            if had_data:
                # 4. new content of the touched partitions (kept rows + folded rows)
                rows = self.spark.read.parquet(fold_path).select(*OUTPUT_COLUMNS)
                kept = existing.join(rows.select(*KEY), KEY, "left_anti")
                content = _laid_out(kept.unionByName(rows))
                content.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(stage)
            else:
                stage = fold_path  # nothing stored yet: the folded rows are the content
        folded = self.spark.read.parquet(fold_path)
        if totals is None:
            actions_path = f"{self._staging()}/actions-{b}"
            if _exists(self.spark, actions_path):
                totals = json.loads(_read_text(self.spark, actions_path))
            else:
                totals_row = action_totals(folded).collect()[0].asDict()
                totals = {c: int(totals_row[c] or 0) for c in ACTION_COLUMNS}
        if stage == fold_path:
            staged = _laid_out(folded.select(*OUTPUT_COLUMNS))
        else:
            staged = self.spark.read.schema(STORED_SCHEMA).parquet(stage)
        (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITIONS).parquet(self.path))
        _write_text(self.spark, self._marker(b), json.dumps(totals))
        self._unstage(b)
        return totals

    def _unstage(self, b: int) -> None:
        """Delete the staged files of an applied batch."""
        for name in (f"emissions-{b}", f"fold-{b}", f"batch={b}", f"actions-{b}"):
            fs, p, _ = _hadoop_fs(self.spark, f"{self._staging()}/{name}")
            fs.delete(p, True)

    def _own(self, granularities: set) -> None:
        """Refuse a second writer of a granularity: its read-compare-write could interleave."""
        for g in granularities:
            path = f"{self.path}/_owners/minutes={g}"
            if not _exists(self.spark, path):
                _write_text(self.spark, path, self.writer)
            elif (owner := _read_text(self.spark, path)) != self.writer:
                raise RuntimeError(f"granularity {g} of {self.path} is written by {owner!r}, not by {self.writer!r}")
