"""The cleanups of an object for a cleanup cadence (``flush_every > 0``).

Each cleanup depends on the one before: it is the first record that finds the clock ``flush_every``
beyond the previous cleanup (the first record's timestamp to begin with).  Only records that raise the
clock matter, and an object's raised clocks only grow, so the recurrence is a walk along a sorted
list: from a clock ``x`` to the first raised clock at ``x + flush_every`` or beyond.

Distributed form.  The clock scan has cut the records into ranges; a range of an object is a chunk of its list.

1. Each chunk finds, for every place at which a walk can enter it, where that walk leaves it
   (jump pointers within the chunk, doubled until they stop).  Walks meet soon, so places side
   by side mostly share their end; a chunk is reduced to a few intervals of entries.
2. The intervals, not the records, are strung together per object: a pass in order of the chunks
   with one clock as its state.
3. Each chunk walks from the clock at which it is entered and returns its cleanups.

So an object with any share of the records is walked by as many tasks as it has ranges.  Windows then
meet the cleanups by value: per object there is at most one cleanup per ``flush_every`` minutes, and one
window per granularity, of event time, whatever its number of records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clockroll.session import ship_package

CHUNK = ["object_id", "part"]
ENTRIES = "object_id int, part int, upto long, leaves long"
ENTERED = "object_id int, part int, entered long"


def walk_ends(clocks: np.ndarray, every: int) -> tuple[np.ndarray, np.ndarray]:
    """For sorted ``clocks``: walks that look for a clock of at most ``upto`` (and more than the one before) leave at
    ``leaves``.  A walk enters less than ``every`` beyond the first clock, or at the first clock from there on."""
    n = len(clocks)
    jump = np.searchsorted(clocks, clocks + every)
    jump = np.where(jump == n, np.arange(n), jump)
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    last = min(int(np.searchsorted(clocks, clocks[0] + every)), n - 1)
    upto, leaves = clocks[:last + 1], clocks[jump[:last + 1]]
    keep = np.append(leaves[1:] != leaves[:-1], True)
    return upto[keep], leaves[keep]


def _entries(every: int):
    def run(table: pa.Table) -> pa.Table:
        upto, leaves = walk_ends(np.sort(table["clock"].to_numpy()), every)
        chunk = [pa.array(np.full(len(upto), table[c][0].as_py()), pa.int32()) for c in CHUNK]
        return pa.table([*chunk, pa.array(upto), pa.array(leaves)], names=[*CHUNK, "upto", "leaves"])
    return run


def _strung(every: int):
    """Rows come by object, chunk and ``upto``: the clock with which each chunk is entered (NULL: it is the object's first)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        obj, part, at, after = None, None, None, None
        for b in batches:
            out: list[tuple] = []
            for o, p, upto, leaves in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if o != obj or p != part:
                    at = after if o == obj else None
                    obj, part, after, found = o, p, at, False
                    out.append((o, p, at))
                if not found and (at is None or upto >= at + every):
                    after, found = leaves, True
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int64()))], names=[*CHUNK, "entered"])
    return run


def _walked(every: int):
    def run(table: pa.Table) -> pa.Table:
        clocks, entered = np.sort(table["clock"].to_numpy()), table["entered"][0].as_py()
        at, got = int(clocks[0]) if entered is None else entered, []
        while (k := int(np.searchsorted(clocks, at + every))) < len(clocks):
            at = int(clocks[k])
            got.append(at)
        return pa.table([pa.array(np.full(len(got), table["object_id"][0].as_py()), pa.int32()), pa.array(got, pa.int64())], names=["object_id", "clock"])
    return run


def cleanups(raised: DataFrame, every_ms: int) -> DataFrame:
    """``object_id`` and ``clock`` of each cleanup.  ``raised``: object_id, part, clock of the records that raise the
    clock (an object's parts follow one another in its arrival order)."""
    ship_package(raised.sparkSession)
    entries = raised.groupBy(*CHUNK).applyInArrow(_entries(every_ms), ENTRIES)
    entered = entries.repartition("object_id").sortWithinPartitions(*CHUNK, "upto").mapInArrow(_strung(every_ms), ENTERED)
    return raised.join(entered, CHUNK).groupBy(*CHUNK).applyInArrow(_walked(every_ms), "object_id int, clock long")


def shut_by(windows: DataFrame, done: DataFrame) -> DataFrame:
    """``windows`` (object_id, due) with ``shut``: the first of the object's cleanups ``done`` at ``due`` or beyond."""
    no = F.lit(None).cast("long")
    rows = windows.select("object_id", "due", no.alias("clock")).unionByName(done.select("object_id", F.col("clock").alias("due"), "clock"))
    later = Window.partitionBy("object_id").orderBy(F.desc("due"), F.col("clock").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("shut", F.last("clock", ignorenulls=True).over(later)).where("clock IS NULL").select("object_id", "due", "shut")


def with_phases(emitted: DataFrame) -> DataFrame:
    """Phases over all emissions of a window: a late record that arrived after the window was
    closed gets 2, one before that 0, the closed window 1; closed rows lose their arrival."""
    arrival = F.struct("arr_major", "arr_minor")
    closed = F.col("kind") == "closed"
    shut = F.min(F.when(closed & F.col("arr_major").isNotNull(), arrival)).over(Window.partitionBy("minutes", "object_id", "ws_ms"))
    out = emitted.withColumn("_shut", shut).withColumn(
        "phase", F.when(closed, 1).when(F.col("_shut") < arrival, 2).otherwise(0))
    for c in ("arr_major", "arr_minor"):
        out = out.withColumn(c, F.when(~closed, F.col(c)))
    return out.drop("_shut")
