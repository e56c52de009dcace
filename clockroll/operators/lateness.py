"""Per-object event-time clock, lateness classification and window emissions (batch form).

Semantics (one object, records in arrival order; size S, lateness L):

* clock ``ta`` = greatest timestamp of the earlier arrivals (late records can never raise
  it, so this equals the running max over all earlier records);
* on time   iff ``ta`` is unset or ``ts >= ta - L``;
* a late record is folded if its window is open -- opened by an earlier on-time record
  and not yet closed -- otherwise it is emitted on its own;
* a window is closed (emitted) by the first cleanup that finds the clock at ``start + S + L`` or
  beyond.  With ``flush_every = 0`` every on-time record is a cleanup; otherwise see ``cadence``;
* with an idle timeout, a pause of at least the timeout between two arrivals of an object ends a
  *generation*: all its open windows are closed.  An on-time record may then open a window again, whose
  second closed row meets the first one in the target.

Distributed form.  The clock is a prefix max in arrival order, the generation a prefix count of pauses.
The measures are dealt once by
ranges of (object, arrival), so a hot object lies in as many tasks as its share of the rows asks
for, whatever its bursts look like; each task sorts its range and runs over it once
(constant memory), and what the earlier ranges of the one object that a range may
begin with add to it comes from a table of at most one row per range boundary.  The result is
written once, with the columns that follow-up steps need.  Everything after that is either
aggregated before it is shuffled (statistics and first arrival of each window, in one aggregate) or concerns
late records only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.functions.timefn import window_start_ms
from clockroll.functions.units import ADVANCED_UNITS, with_stdev
from clockroll.session import scratch_dir, ship_package
from clockroll.sources.measures import MEASURE_COLUMNS
from clockroll.operators.aggregate import (OUTPUT_COLUMNS, arrival, finalize_stats, last_order, stats_aggs,
                                           with_keys)

EMISSION_COLUMNS = OUTPUT_COLUMNS + ["kind", "phase", "arr_major", "arr_minor"]
#: A window's statistics belong to one generation of it (always 0 without an idle timeout).
WINDOW_KEY = ["minutes", "object_id", "ws_ms", "gen"]


def _scanned(timeouts: list[int]) -> str:
    gaps = "".join(f", gaps{i} long" for i in range(len(timeouts)))
    return "object_id int, unit string, ts_ms long, value double, arr_major long, arr_minor long, part int, seen long" + gaps


def _running(timeouts: list[int]):
    """``seen``: the greatest timestamp of the object's earlier rows in this task (rows come by
    object and arrival); ``gaps*``: its pauses of at least each timeout (microseconds) in this task so far;
    ``part``: the task's place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, obj, top, came, count = TaskContext.get().partitionId(), None, None, None, [0] * len(timeouts)
        for b in batches:
            if not b.num_rows:
                continue
            ids, ts, arr = np.asarray(b.column(0)), np.asarray(b.column(2)), np.asarray(b.column(4))
            starts = np.concatenate(([True], ids[1:] != ids[:-1]))
            goes_on = int(ids[0]) == obj
            run = np.cumsum(starts) - 1
            # One running max over all objects: each is lifted above the one before.
            base = int(min(ts.min(), top if top is not None else ts.min()))
            lift = int(max(ts.max(), top if top is not None else ts.max())) - base + 1
            if lift * (int(run[-1]) + 1) < 1 << 62:
                lifted = ts - base + run * lift
                if goes_on:
                    lifted[0] = max(lifted[0], top - base)
                upto = np.maximum.accumulate(lifted) - run * lift + base
            else:  # timestamps too far apart to be lifted
                upto = np.concatenate([np.maximum.accumulate(x) for x in np.split(ts, np.flatnonzero(starts)[1:])])
                if goes_on:
                    upto[run == 0] = np.maximum(upto[run == 0], top)
            seen = np.concatenate(([0], upto[:-1]))
            unknown = starts.copy()
            if goes_on:
                seen[0], unknown[0] = top, False
            before = np.concatenate(([came if goes_on else arr[0]], arr[:-1]))
            gaps = []
            for i, t in enumerate(timeouts):
                pause = ((arr - before >= t) & ~unknown).astype(np.int64)
                total = np.cumsum(pause)
                first = np.maximum.accumulate(np.where(starts, np.arange(len(ids)), 0))
                own = total - (total - pause)[first] + np.where((run == 0) & goes_on, count[i], 0)
                gaps.append(own)
                count[i] = int(own[-1])
            obj, top, came = int(ids[-1]), int(upto[-1]), int(arr[-1])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(6)), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(seen, pa.int64(), mask=unknown), *map(pa.array, gaps)],
                names=[*MEASURE_COLUMNS, "part", "seen", *(f"gaps{i}" for i in range(len(timeouts)))])
    return run


class Clocked:
    """The measures in arrival order with their clock, written once.  ``rows``: the measure columns, ``part``,
    ``ta_ms`` (the object's clock just before each record, NULL for its first) and ``gen0``, ``gen1``, ... (its
    generation for each idle timeout, in microseconds of ``arr_major``); ``objects``: each object's final clock ``final_ta`` and
    last generations ``last0``, ``last1``, ..."""

    def __init__(self, measures: DataFrame, timeouts: list[int] = (), parts: int | None = None):
        spark = measures.sparkSession
        ship_package(spark)
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        order, n, schema = ["object_id", "arr_major", "arr_minor"], len(timeouts), _scanned(timeouts)
        # A range border is drawn from a sample of the rows, so it must be drawn once: the scanned rows
        # are written, and what is carried is read from what was written.
        path = scratch_dir(spark, "clock") + "/scan"
        (measures.select(*MEASURE_COLUMNS).repartitionByRange(parts, *order).sortWithinPartitions(*order)
         .mapInArrow(_running(timeouts), schema).write.parquet(path))
        scan = spark.read.schema(schema).parquet(path)
        tops = scan.groupBy("object_id", "part").agg(
            F.max("ts_ms").alias("top"), F.min("arr_major").alias("came"), F.max("arr_major").alias("went"), *[F.max(f"gaps{i}").alias(f"gaps{i}") for i in range(n)])
        at = Window.partitionBy("object_id").orderBy("part")
        before = at.rowsBetween(Window.unboundedPreceding, -1)
        tops = tops.withColumn("prior", F.max("top").over(before))
        for i, t in enumerate(timeouts):
            pause = F.coalesce((F.col("came") - F.lag("went").over(at) >= t).cast("long"), F.lit(0))  # between two ranges
            tops = tops.withColumn(f"pause{i}", pause)
            tops = tops.withColumn(f"base{i}", F.coalesce(F.sum(F.col(f"gaps{i}") + F.col(f"pause{i}")).over(before), F.lit(0)) + F.col(f"pause{i}"))
        tops = _staged(tops)
        # Only the first object of a range can have rows in earlier ranges: at most `parts` rows.
        carried = tops.where("prior IS NOT NULL").select("object_id", "part", "prior", *[f"base{i}" for i in range(n)])
        met = scan.join(F.broadcast(carried), ["object_id", "part"], "left")
        self.rows = met.select(*MEASURE_COLUMNS, "part", F.greatest("prior", "seen").alias("ta_ms"),
                               *[(F.col(f"gaps{i}") + F.coalesce(f"base{i}", F.lit(0))).alias(f"gen{i}") for i in range(n)])
        self.objects = tops.groupBy("object_id").agg(F.max("top").alias("final_ta"), *[F.max(F.col(f"gaps{i}") + F.col(f"base{i}")).alias(f"last{i}") for i in range(n)])


def with_clock(measures: DataFrame, parts: int | None = None) -> DataFrame:
    """Add ``ta_ms``: the object's clock just before each record (NULL for its first)."""
    return Clocked(measures, parts=parts).rows.select(*MEASURE_COLUMNS, "ta_ms")


def object_clock(measures: DataFrame) -> DataFrame:
    """Final clock of each object (greatest timestamp seen)."""
    return measures.groupBy("object_id").agg(F.max("ts_ms").alias("time_advance"),
                                              F.count(F.lit(1)).alias("records"))


class _Classified:
    """The measures once per configuration, with their fate.

    ``on_time`` and ``late`` are frames of the measure columns plus minutes, ws_ms, gen, ta_ms; ``late`` has ``opened``,
    ``earlier`` (generations of its window that ended before its own) and ``status`` too.  ``opened`` has one row per
    ``WINDOW_KEY``: the statistics of its on-time records, its first arrival ``_first_on`` and ``shut``, the clock
    that closes it (NULL: no cleanup does)."""

    def __init__(self, measures: DataFrame, cfgs: list[RollupConfig], idle: bool = False, advanced=ADVANCED_UNITS):
        from clockroll.operators.cadence import cleanups, shut_by

        gs = [c.granularity for c in cfgs]
        if len(set(gs)) != len(gs):
            raise ValueError("one configuration per granularity")
        self.idle, timeouts = idle, sorted({c.timeout_ms * 1000 for c in cfgs}) if idle else []
        generation = lambda c, name: F.col(f"{name}{timeouts.index(c.timeout_ms * 1000)}") if idle else F.lit(0).cast("long")
        clocked = Clocked(measures, timeouts)
        per_cfg = F.array(*[F.struct(
            F.lit(c.granularity).alias("minutes"),
            window_start_ms(F.col("ts_ms"), c.granularity, c.align).alias("ws_ms"), generation(c, "gen").alias("gen"),
            F.lit(c.lateness_ms).cast("long").alias("_lat_ms")) for c in cfgs])
        rows = clocked.rows.select(*MEASURE_COLUMNS, "ta_ms", F.explode(per_cfg).alias("_c")).select(*MEASURE_COLUMNS, "ta_ms", "_c.*")
        on_time = F.col("ta_ms").isNull() | (F.col("ts_ms") >= F.col("ta_ms") - F.col("_lat_ms"))
        self.on_time = rows.where(on_time).drop("_lat_ms")
        of = lambda pairs: reduce(lambda e, p: e.when(F.col("minutes") == p[0], p[1]), pairs[1:], F.when(F.col("minutes") == pairs[0][0], pairs[0][1]))
        self.last_gen = of([(c.granularity, generation(c, "last")) for c in cfgs])
        self.objects = clocked.objects
        due = F.col("ws_ms") + of([(c.granularity, F.lit(c.size_ms + c.lateness_ms).cast("long")) for c in cfgs])
        opened = self.on_time.groupBy(*WINDOW_KEY).agg(*stats_aggs(advanced), F.max(last_order()).alias("_last_at"), F.min(arrival()).alias("_first_on"))
        opened = _staged(opened.withColumn("due", due))
        parts = [opened.where(F.col("minutes").isin([c.granularity for c in cfgs if not c.flush_every])).withColumn("shut", F.col("due"))]
        raised = clocked.rows.where("ta_ms IS NULL OR ts_ms > ta_ms").select("object_id", "part", F.col("ts_ms").alias("clock"))
        for every in sorted({c.flush_every_ms for c in cfgs if c.flush_every}):
            own = opened.where(F.col("minutes").isin([c.granularity for c in cfgs if c.flush_every_ms == every]))
            shut = shut_by(own.select("object_id", "due").distinct(), cleanups(raised, every))
            parts.append(own.join(shut, ["object_id", "due"], "left").select(*opened.columns, "shut"))
        opened = reduce(DataFrame.unionByName, parts)
        self.opened = _staged(opened) if len(parts) > 1 else opened
        late = rows.where(~on_time).drop("_lat_ms").join(self.opened.select(*WINDOW_KEY, "_first_on", "shut"), WINDOW_KEY, "left")
        was_opened = F.coalesce(F.col("_first_on") < arrival(), F.lit(False))
        still_open = was_opened & F.coalesce(F.col("ta_ms") < F.col("shut"), F.lit(True))
        late = late.withColumn("opened", was_opened).withColumn("status", F.when(still_open, "late_open").otherwise("late")).drop("_first_on", "shut")
        self.late = _staged(late.withColumn("earlier", F.lit(0).cast("long")) if not idle else self._with_earlier(late))

    def _with_earlier(self, late: DataFrame) -> DataFrame:
        """``earlier``: windows and generations meet by window, one row each, before the records do."""
        window = WINDOW_KEY[:3]
        gens = self.opened.select(*window, F.col("gen").alias("ended"))
        asked = late.select(*WINDOW_KEY).distinct()
        counts = asked.join(gens, window).where("ended < gen").groupBy(*WINDOW_KEY).agg(F.count(F.lit(1)).alias("earlier"))
        return late.join(counts, WINDOW_KEY, "left").withColumn("earlier", F.coalesce("earlier", F.lit(0)))

    def all(self) -> DataFrame:
        return self.on_time.withColumn("status", F.lit("on_time")).unionByName(self.late.drop("opened", "earlier"))


def _staged(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "late") + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def classify_many(measures: DataFrame, cfgs: list[RollupConfig], idle_timeout: bool = False) -> DataFrame:
    """Every measure for several (granularity, lateness) configurations: measure columns plus
    minutes, ws_ms, ta_ms, status (and ``gen`` with an idle timeout).  The object clock does not depend on the
    granularity and is computed once."""
    out = _Classified(measures, cfgs, idle_timeout).all()
    return out if idle_timeout else out.drop("gen")


def classify_arrivals(measures: DataFrame, cfg: RollupConfig) -> DataFrame:
    """Every measure with its window start, the clock before it and its fate:
    ``on_time``, ``late_open`` (folded into a window still open) or ``late`` (emitted alone)."""
    return classify_many(measures, [cfg]).drop("minutes")


def _late_rows(late: DataFrame, advanced) -> DataFrame:
    """A record emitted alone: count 1, k = value, k sums 0, std 0 (NULL for basic units)."""
    adv = with_stdev(F.col("unit"), advanced)
    pos = F.col("ts_ms") > 0
    closings = F.col("earlier") + F.col("opened").cast("long")
    out = late.select(
        "minutes", "object_id", "ws_ms",
        F.lit(1).cast("long").alias("count"), F.col("value").alias("sum"),
        F.col("value").alias("min"), F.col("value").alias("max"), F.col("value").alias("mean"),
        F.when(pos, F.col("value")).otherwise(F.lit(0.0)).alias("last"),
        F.greatest(F.col("ts_ms"), F.lit(0).cast("long")).alias("last_ts"),
        F.when(adv, F.col("value")).alias("k"), F.when(adv, F.lit(0.0)).alias("k_sum"),
        F.when(adv, F.lit(0.0)).alias("k_sum_2"), F.when(adv, F.lit(0.0)).alias("std"),
        F.lit("late").alias("kind"), (2 * closings).cast("int").alias("phase"),
        "arr_major", "arr_minor")
    return with_keys(out).select(*EMISSION_COLUMNS)


def _with_folded(opened: DataFrame, late: DataFrame, advanced) -> DataFrame:
    """The statistics of the windows with those of the late records folded into them: only windows that took
    some in are changed.  A window's first record is on time, so ``_k`` and ``_adv`` stay."""
    stats = ["_n", "_sum", "_min", "_max", "_last_ts", "_last", "_var", "_last_at"]
    more = (late.where("status = 'late_open'").groupBy(*WINDOW_KEY).agg(*stats_aggs(advanced), F.max(last_order()).alias("_last_at"))
            .select(*WINDOW_KEY, *[F.col(c).alias("x" + c) for c in stats]))
    met = opened.join(more, WINDOW_KEY, "left")
    c = {s: (F.col(s), F.col("x" + s)) for s in stats}
    n = c["_n"][0] + c["_n"][1]
    apart = c["_sum"][1] / c["_n"][1] - c["_sum"][0] / c["_n"][0]
    squares = c["_var"][0] * c["_n"][0] + c["_var"][1] * c["_n"][1] + apart * apart * c["_n"][0] * c["_n"][1] / n
    newer = c["_last_at"][1] > c["_last_at"][0]
    both = {"_n": n, "_sum": c["_sum"][0] + c["_sum"][1], "_min": F.least(*c["_min"]), "_max": F.greatest(*c["_max"]), "_last_ts": F.greatest(*c["_last_ts"]),
            "_last": F.when(newer, c["_last"][1]).otherwise(c["_last"][0]), "_var": squares / n}
    merged = [F.when(c["_n"][1].isNull(), F.col(s)).otherwise(e).alias(s) for s, e in both.items()]
    return met.select(*WINDOW_KEY, "shut", "_k", "_adv", *merged)


def _window_rows(classified: _Classified, advanced) -> DataFrame:
    """Accepted records grouped per window and generation, with a ``closed`` flag (from the final clock and the last
    generation) and their ``phase``."""
    agg = _with_folded(classified.opened, classified.late, advanced).join(classified.objects, "object_id")
    closed = F.coalesce(F.col("shut") <= F.col("final_ta"), F.lit(False)) | (F.col("gen") < classified.last_gen)
    nth = F.lit(1)
    if classified.idle:
        nth = F.row_number().over(Window.partitionBy(*WINDOW_KEY[:3]).orderBy("gen"))
    out = finalize_stats(agg).withColumn("closed", closed).withColumn("phase", (2 * nth - 1).cast("int"))
    return with_keys(out.select(*WINDOW_KEY[:3], *OUTPUT_COLUMNS[4:], "closed", "phase"))


def emissions(measures: DataFrame, cfg: RollupConfig, flush_at_end: bool = False,
              advanced=ADVANCED_UNITS, idle_timeout: bool = False) -> DataFrame:
    """What the stream would emit: closed windows (``kind='closed'``) and single late records
    (``kind='late'``).  ``phase`` orders the emissions of a window: the n-th closed row of it has 2n - 1, a late
    record twice the number of closed rows before it (without an idle timeout: 0 = before the window was
    opened, 1 = closed, 2 = after it was closed).  ``flush_at_end`` also emits windows still open.
    ``idle_timeout``: windows of an object that pauses for ``cfg.timeout`` are closed; ``arr_major`` must then be
    microseconds."""
    return emissions_many(measures, [cfg], flush_at_end, advanced, idle_timeout)


def emissions_many(measures: DataFrame, cfgs: list[RollupConfig], flush_at_end: bool = False,
                   advanced=ADVANCED_UNITS, idle_timeout: bool = False) -> DataFrame:
    """Emissions for several granularities (each with its own lateness, timeout and cleanup cadence) from
    one pass over the measures."""
    classified = _Classified(measures, cfgs, idle_timeout, advanced)
    windows = _window_rows(classified, advanced)
    if not flush_at_end:
        windows = windows.filter("closed")
    closed = windows.select(*OUTPUT_COLUMNS, F.lit("closed").alias("kind"), "phase",
                            F.lit(None).cast("long").alias("arr_major"),
                            F.lit(None).cast("long").alias("arr_minor"))
    return closed.unionByName(_late_rows(classified.late.where("status = 'late'"), advanced))


def open_windows_at_end(measures: DataFrame, cfg: RollupConfig, advanced=ADVANCED_UNITS, idle_timeout: bool = False) -> DataFrame:
    """Windows still held in state after the last record (what the idle timeout flushes)."""
    return _window_rows(_Classified(measures, [cfg], idle_timeout, advanced), advanced).filter(~F.col("closed")).select(*OUTPUT_COLUMNS)
