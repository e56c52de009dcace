"""Idle timeout, re-created windows and the cleanup cadence in batch against a record-by-record simulation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clockroll.config import RollupConfig
from clockroll.operators import cadence
from clockroll.operators.lateness import Clocked, classify_many, emissions, emissions_many, open_windows_at_end
from clockroll.operators.merge import action_totals, upsert
from clockroll.sources.target import TARGET_SCHEMA
from tests.reference_fold import MIN, sink_apply, stats, window_of
from tests.test_batch_vs_fold import close, to_df

T0 = 1704067200000
SCHEMA = "object_id int, unit string, ts_ms long, value double, arr_major long, arr_minor long"


def history(seed, n=500, objects=3, units=("V", "lx", "W")):
    """Bursts with pauses in between; some records are sent hours late."""
    rnd, out, now = random.Random(seed), [], {o: T0 for o in range(objects)}
    for i in range(n):
        o = rnd.randrange(objects)
        now[o] += rnd.choice([1000, 20_000, 60_000, 300_000, 1_200_000, 2_400_000])
        ts = now[o] - rnd.choice([0, 0, 0, 60_000, 600_000, 1_500_000, 5_000_000])
        out.append((o, units[o % len(units)], ts, round(rnd.uniform(-9, 9), 2), now[o] * 1000, i))
    return out


def simulate(records, g, lateness, every, timeout, flush_end=False):
    """Emissions (object, start, kind, phase, statistics, arrival) in the order they happen, and the windows left open."""
    out, left = [], []
    for o in sorted({r[0] for r in records}):
        rs = sorted((r for r in records if r[0] == o), key=lambda r: r[4:])
        clock = cleaned = came = None
        windows, closings = {}, {}

        def shut(w):
            closings[w] = closings.get(w, 0) + 1
            out.append((o, w, "closed", 2 * closings[w] - 1, *stats(windows.pop(w)), None, None))

        for _, unit, ts, v, major, minor in rs:
            if came is not None and timeout and major - came >= timeout * MIN * 1000:
                for w in sorted(windows):
                    shut(w)
            came = major
            if clock is None:
                clock = cleaned = ts
            w = window_of(ts, g)
            on_time = ts >= clock - lateness * MIN
            if on_time or w in windows:
                windows.setdefault(w, []).append((unit, ts, v))
            else:
                out.append((o, w, "late", 2 * closings.get(w, 0), *stats([(unit, ts, v)]), major, minor))
                continue
            clock = max(clock, ts)
            if on_time and clock - cleaned >= every * MIN:
                cleaned = clock
                for x in sorted(windows):
                    if x + (g + lateness) * MIN <= clock:
                        shut(x)
        if flush_end:
            for w in sorted(windows):
                shut(w)
        left += [(o, w, len(x)) for w, x in windows.items()]
    return out, left


def _got(em):
    em = em.withColumn("ws_ms", F.unix_millis(F.col("timestamp").cast("timestamp")))
    return [tuple(r) for r in em.select("object_id", "ws_ms", "kind", "phase", "count", "sum", "min", "max", "mean", "last", "last_ts", "k", "k_sum", "k_sum_2", "std", "arr_major", "arr_minor").collect()]


def _same(got, want):
    order = lambda e: (e[0], e[1], e[3], e[15] or 0, e[16] or 0)
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [e[:5] for e in got] == [e[:5] for e in want]
    assert all(close(a, b) for x, y in zip(got, want, strict=True) for a, b in zip(x[5:], y[5:], strict=True))


@pytest.mark.parametrize("seed,g,lat,every,timeout,parts,flush_end", [
    (1, 15, 5, 0, 20, 4, False), (2, 60, 0, 0, 60, 30, True), (3, 15, 5, 2, 20, 30, False), (4, 25, 10, 7, 40, 1, True), (5, 60, 30, 30, 90, 12, False)])
def test_idle_timeout_matches_simulation(spark, seed, g, lat, every, timeout, parts, flush_end):
    recs = history(seed)
    cfg = RollupConfig(granularity=g, allowed_lateness=lat, timeout=timeout, flush_every=every)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = _got(emissions(to_df(spark, recs), cfg, flush_at_end=flush_end, idle_timeout=True))
        left = open_windows_at_end(to_df(spark, recs), cfg, idle_timeout=True).select(
            "object_id", F.unix_millis(F.col("timestamp").cast("timestamp")), "count").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want, open_ = simulate(recs, g, lat, every, timeout, flush_end)
    _same(got, want)
    if not flush_end:
        assert sorted(map(tuple, left)) == sorted(open_)
    assert any(e[3] >= 2 for e in want) and any(e[3] > 1 and e[2] == "closed" for e in want) or g == 60


def test_recreated_windows_meet_their_stored_row(spark):
    """A window opened again is skipped if it has no more records than the stored row, and replaces it otherwise."""
    m, h = 60_000, 3_600_000
    at = lambda *mins: [(1, "V", T0 + ts * m, float(i), (T0 + came * m) * 1000, i) for i, (ts, came) in enumerate(mins)]
    cfg = RollupConfig(granularity=15, allowed_lateness=5, timeout=20, flush_every=0)
    skip = at((1, 1), (2, 2), (3, 30), (40, 60))
    override = at((1, 1), (2, 30), (3, 31), (40, 60))
    late = at((1, 1), (2, 30), (40, 41), (3, 42))  # the window was opened and closed twice before
    empty = spark.createDataFrame([], TARGET_SCHEMA)
    for recs, want in ((skip, {"rec_normal": 1, "rec_skip": 1}), (override, {"rec_normal": 1, "rec_override": 1}), (late, {"rec_normal": 1, "rec_skip": 1, "rec_late": 1, "rec_late_update": 1})):
        em = emissions(to_df(spark, recs), cfg, idle_timeout=True)
        acts = {k: v for k, v in action_totals(upsert(empty, em)[1]).first().asDict().items() if v}
        assert acts == want
        table = {}
        assert {k: v for k, v in sink_apply(table, simulate(recs, 15, 5, 0, 20)[0]).items() if v} == want
    assert h  # (an hour holds all of it)


def test_equal_pause_and_several_timeouts(spark):
    """A pause of exactly the timeout ends a generation; configurations have timeouts of their own."""
    recs = [(1, "V", T0 + i * 1000, 1.0, (T0 + c * 60_000) * 1000, i) for i, c in enumerate([0, 20, 39, 100])]
    a = RollupConfig(granularity=15, allowed_lateness=5, timeout=20, flush_every=0)
    b = RollupConfig(granularity=60, allowed_lateness=0, timeout=62, flush_every=0)
    rows = classify_many(to_df(spark, recs), [a, b], idle_timeout=True).orderBy("minutes", "arr_major").collect()
    assert [(r.minutes, r.gen) for r in rows] == [(15, 0), (15, 1), (15, 1), (15, 2), (60, 0), (60, 0), (60, 0), (60, 0)]
    got = _got(emissions_many(to_df(spark, recs), [a, b], idle_timeout=True, flush_at_end=True))
    assert sorted((e[3], e[4]) for e in got) == [(1, 1), (1, 4), (3, 2), (5, 1)]


def test_no_records(spark):
    none = spark.createDataFrame([], SCHEMA)
    for every in (0, 2):
        assert emissions(none, RollupConfig(granularity=15, allowed_lateness=5, flush_every=every), idle_timeout=True).count() == 0


# --- cadence -----------------------------------------------------------------------------

def _walk(clocks, every):
    at, out = clocks[0], []
    for c in clocks:
        if c - at >= every:
            at = c
            out.append(c)
    return out


@pytest.mark.parametrize("seed,step", [(1, 40), (2, 400), (3, 5)])
def test_cleanups_of_an_object_in_many_chunks(spark, seed, step):
    rnd = random.Random(seed)
    rows, want = [], set()
    for o in range(3):
        clocks = np.cumsum([rnd.randrange(1, step) for _ in range(600)]).tolist()
        cuts = sorted(rnd.sample(range(1, 600), 25))
        rows += [(o, sum(i >= c for c in cuts) * 2, c) for i, c in enumerate(clocks)]
        want |= {(o, c) for c in _walk(clocks, 120)}
    rnd.shuffle(rows)
    got = cadence.cleanups(spark.createDataFrame(rows, "object_id int, part int, clock long"), 120).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_walk_ends_of_one_chunk():
    clocks = np.array([10, 11, 15, 130, 131, 140, 400])
    upto, leaves = cadence.walk_ends(clocks, 120)
    for target in range(5, 131):
        entry = int(clocks[np.searchsorted(clocks, target)])
        end = [entry, *_walk([entry, *clocks[clocks > entry].tolist()], 120)][-1]
        assert leaves[np.searchsorted(upto, target)] == end


def test_one_object_is_walked_by_all_tasks(spark):
    """The records of one object are dealt over all ranges; no later step puts them into one task again."""
    rows = spark.range(4000).selectExpr("1 AS object_id", "'V' AS unit", f"{T0} + id * 1000 AS ts_ms", "1.0D AS value", "id AS arr_major", "0L AS arr_minor")
    clocked = Clocked(rows, parts=10)
    raised = clocked.rows.where("ta_ms IS NULL OR ts_ms > ta_ms").select("object_id", "part", F.col("ts_ms").alias("clock"))
    sizes = [r["count"] for r in raised.groupBy("part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 800
    plan = cadence.cleanups(raised, 120_000)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning(object_id" in line:  # by object alone only the intervals are dealt
            assert "part" in line.split("hashpartitioning(")[1] or "entries" not in line
    entries = raised.groupBy("object_id", "part").applyInArrow(cadence._entries(120_000), cadence.ENTRIES)
    assert entries.count() <= 10 * 121  # at most one interval a clock within the cadence, here one a second
