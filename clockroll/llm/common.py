"""Small helpers the operators share: words, free column names, staged tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from clockroll.session import scratch_dir, ship_package

#: White space that separates words everywhere in this package: blank, TAB to CR.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def words_of(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts give []."""
    lines = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    # translate() works character by character: only where a rare kind of blank stands.
    blanks = F.when(lines.rlike(r"[\x09-\x0D]"), F.translate(lines, "\t\x0b\x0c\r", "    ")).otherwise(lines)
    return F.array_remove(F.split(blanks, " "), "")


def free_name(taken: Sequence[str], wish: str) -> str:
    """``wish``, or ``wish`` with underscores before it until no column has that name."""
    low = {c.lower() for c in taken}
    while wish.lower() in low:
        wish = "_" + wish
    return wish


def packed(df: DataFrame, name: str = "_row") -> DataFrame:
    """All columns of each row in one struct, so that helper columns cannot clash with them."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name))


def staged(df: DataFrame, purpose: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the cluster's shared scratch folder and read it back: cuts the lineage
    and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose) + "/t"
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


#: Partitions for each core in which a gathered table is written.
TASKS_A_CORE = 3


def gathered(df: DataFrame) -> DataFrame:
    """``df`` in no more partitions than ``TASKS_A_CORE`` for each core: a task takes several partitions of a shuffle
    one after another.  What is small for the number of shuffle partitions is then not written as a file
    for each of them, and all cores still have work when it is large."""
    return df.coalesce(TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def freed(*frames: DataFrame) -> None:
    """Delete staged tables that nothing will read again."""
    for df in frames:
        fs, p, _ = _hadoop_fs(df.sparkSession, df._staged_at)
        fs.delete(p, True)


def _hadoop_fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 1 << 20


def byte_slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of ``column`` have about ``limit`` bytes in each part; a longer
    text is a part of its own.  What a worker holds then does not depend on how many long texts a
    batch has."""
    for b in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(b.column(column)), 0)).astype(np.int64) + 64
        upto, lo = np.cumsum(size), 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + limit, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
        b = None  # not held while the next is read
        spare()


def spare() -> None:
    """Arrow's pool gives back what is not in use; it would keep it between batches and tasks."""
    pa.default_memory_pool().release_unused()


#: Rows of keys that a join may broadcast, and bytes of such rows (the driver builds the table and holds several
#: times as much); above either the same join is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 8 << 20


def sized(keys: DataFrame) -> DataFrame:
    """A staged table of keys, marked for broadcast only if its rows are counted to be few for their width."""
    width = 8 * (1 + len(keys.columns))
    return F.broadcast(keys) if keys.count() <= min(BROADCAST_ROWS, BROADCAST_BYTES // width) else keys


_held: list = []


def held(shared, make):
    """``make(value)`` of a broadcast, kept between the tasks of a worker.  A worker holds one such thing: what an
    earlier operator built goes, as workers outlive the stages of a pipeline."""
    if not _held or _held[0] is not shared:
        _held.clear()
        _held[:] = [shared, make(shared.value)]
    return _held[1]


def unheld() -> None:
    """Nothing is held any more."""
    _held.clear()
    spare()


def shared_files(path: str):
    """The file system of a shared folder (as executors see it) and the folder's path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


#: Bytes of rows that go to a Python worker at a time, and the session's setting for it.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def on_workers(df: DataFrame) -> DataFrame:
    """Make this package importable by the Python workers that will run over ``df``, and bound the bytes of a batch:
    10,000 texts at a time are held by the executor's JVM, outside its heap, and by the worker.  A session that
    sets the bound itself keeps its own."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return df
