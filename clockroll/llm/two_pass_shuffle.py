"""Operator 8: two-pass external shuffle into shards.

Pass 1 scatters the records into buckets by a seeded hash.  The number of buckets follows the
size of the table, so that each holds about ``bucket_bytes`` however large the table is.
Pass 2 takes one bucket at a time, in a fixed order, applies a seeded Fisher-Yates
shuffle and writes it.  The buckets laid end to end are a random permutation; shard ``s`` of
``n`` takes the positions ``s * rows // n`` up to ``(s + 1) * rows // n``, so the row counts of
shards differ by one at most (law ``rows``) and each task writes whole runs of slots.

The result does not depend on partitions, task order or retries: bucket, order and draws are
functions of the seed and the records.  Records equal in every column are interchangeable; where there
are more than ``REPEATED`` of one kind they are counted, and their copies are scattered by number, so
no bucket grows with them.

Defined cases: null texts are written as null and have size 8; null ids hash like a value of
their own; an empty table writes an empty table.  Further columns travel with their record;
columns named ``shard`` or ``slot`` are renamed with a leading underscore.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from clockroll.llm.common import free_name, on_workers, sized, staged

SEED = 20_240_613
REPEATED = 1024
EMIT_ROWS = 1024


def _permuted(seed: int, bucket: int, n: int) -> list[int]:
    """The places 0 to n - 1 in the order of a seeded Fisher-Yates shuffle."""
    draw, at = random.Random(f"{seed}:{bucket}"), list(range(n))
    for i in range(n - 1, 0, -1):
        j = draw.randrange(i + 1)
        at[i], at[j] = at[j], at[i]
    return at


def _shuffled(seed: int, place: str):
    """Rows come by bucket (the first column) and in a fixed order within it."""
    def flush(bucket: int, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        at = _permuted(seed, bucket, table.num_rows)
        cols = [c.chunk(0) for c in table.columns]
        for lo in range(0, len(at), EMIT_ROWS):
            some = pa.array(at[lo:lo + EMIT_ROWS], pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(some) for c in cols), pa.array(range(lo, lo + len(some)), pa.int64())], names=[*table.column_names, place])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.asarray(b.column(0))
            cut = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if held and int(ids[lo]) != now:
                    yield from flush(now, held)
                    held = []
                now = int(ids[lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from flush(now, held)
    return run


def _copies_apart(keyed: DataFrame, h1: str, h2: str, cols: list[str]) -> DataFrame:
    """``keyed`` with hashes of their own for the copies of records that occur very often."""
    often = staged(keyed.groupBy(h1, h2).agg(F.count("*").alias("n")).where(F.col("n") > REPEATED).select(h1, h2), "shuffle-often")
    if often.isEmpty():
        return keyed
    n, copy = (free_name([*cols, h1, h2], x) for x in ("n", "copy"))
    keys = sized(often)
    whole = F.struct(*[F.col(f"`{c}`") for c in cols])
    same = keyed.join(keys, [h1, h2], "left_semi").groupBy(h1, h2).agg(F.first(whole).alias("_whole"), F.count("*").alias(n))
    apart = same.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))).withColumn(h1, F.xxhash64(h1, copy))
    return keyed.join(keys, [h1, h2], "left_anti").unionByName(apart.select("_whole.*", h1, h2))


def _begins(counts: DataFrame, bucket: str, width: int = 4096) -> DataFrame:
    """Where each bucket begins: sums within groups of ``width`` buckets, and before each group."""
    grouped = counts.withColumn("block", F.floor(F.col(bucket) / width))
    blocks = grouped.groupBy("block").agg(F.sum("n").alias("m"))
    before = blocks.select("block", (F.sum("m").over(W.orderBy("block")) - F.col("m")).alias("before"))
    within = F.sum("n").over(W.partitionBy("block").orderBy(bucket)) - F.col("n")
    return grouped.withColumn("within", within).join(before, "block").select(bucket, (F.col("before") + F.col("within")).alias("begin"))


def write_shards(df: DataFrame, path: str, n_shards: int = 24, seed: int = SEED, bucket_bytes: int = 16 << 20, text_col: str = "text") -> None:
    """Shuffle all rows of ``df`` and write them to ``path``, one folder per ``shard``, with ``slot``."""
    spark = on_workers(df).sparkSession
    for c in ("shard", "slot"):
        if c in {x.lower() for x in df.columns}:
            df = df.withColumnRenamed(c, free_name([*df.columns, "shard", "slot"], c))
    cols = df.columns
    bucket, h1, h2, place = (free_name(cols, x) for x in ("bucket", "hash1", "hash2", "place"))
    whole = [F.col(f"`{c}`") for c in cols]
    total = df.select(F.count("*").alias("n"), F.coalesce(F.sum(F.coalesce(F.octet_length(df[f"`{text_col}`"]), F.lit(0)) + 64), F.lit(0)).alias("b")).first()
    n_buckets = max(1, -(-total["b"] // bucket_bytes))
    keyed = df.withColumn(h1, F.xxhash64(F.lit(seed), *whole)).withColumn(h2, F.xxhash64(F.lit(seed + 1), *whole))
    scattered = _copies_apart(keyed, h1, h2, cols).withColumn(bucket, F.pmod(F.col(h1), F.lit(n_buckets)))
    # One row per bucket: where it begins in the permutation.
    counts = scattered.groupBy(bucket).agg(F.count("*").alias("n"))
    begins = _begins(counts, bucket)
    schema = T.StructType([*scattered.select(bucket, *whole).schema.fields, T.StructField(place, T.LongType())])
    ordered = scattered.repartition(F.col(bucket)).sortWithinPartitions(bucket, h1, h2)
    shuffled = ordered.select(bucket, *whole).mapInArrow(_shuffled(seed, place), schema)
    pos, n = F.col("begin") + F.col(place), total["n"]
    # ceil(n_shards * (pos + 1) / n) - 1 in whole numbers
    shard = F.expr(f"({n_shards} * (begin + `{place}` + 1) - 1) div {max(n, 1)}")
    out = (shuffled.join(F.broadcast(begins) if n_buckets <= 100_000 else begins, bucket)
           .withColumn("shard", shard.cast("int"))
           .withColumn("slot", pos - F.expr(f"(shard * {n}L) div {n_shards}")))
    out.select(*whole, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, df: DataFrame) -> DataFrame:
    """The written records with ``shard`` and ``slot``; ``df`` gives the columns."""
    fields = [T.StructField(free_name([*df.columns, "shard", "slot"], f.name) if f.name.lower() in ("shard", "slot") else f.name, f.dataType) for f in df.schema.fields]
    return spark.read.schema(T.StructType([*fields, T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())])).parquet(path)


def digests(shards: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per record: size, CRC of the text, the law, and where it went."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return shards.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
