"""Oracles for tests, written from the definitions and independent of the package: every fate
of a record is decided from the list of all records that arrived before it."""

from __future__ import annotations

import math

ADVANCED = {"%", "A", "ppm", "V", "W", "°C"}
MIN, HOUR = 60_000, 3_600_000


def window_of(ts, minutes, align="hour"):
    if align == "epoch":
        return ts // (minutes * MIN) * (minutes * MIN)
    hour = ts // HOUR * HOUR
    return hour + (ts - hour) // MIN // minutes * minutes * MIN


def stats(rows):
    """count .. std of records (unit, ts, value) in arrival order."""
    xs = [v for _, _, v in rows]
    n, total = len(xs), sum(xs)
    top = max(ts for _, ts, _ in rows)
    last = next(v for _, ts, v in rows if ts == top) if top > 0 else 0.0
    k = ks = ks2 = std = None
    if rows[0][0] in ADVANCED:
        k = xs[0]
        ks, ks2 = sum(x - k for x in xs), sum((x - k) ** 2 for x in xs)
        std = math.sqrt(sum((x - total / n) ** 2 for x in xs) / n)
    return n, total, min(xs), max(xs), total / n, last, max(top, 0), k, ks, ks2, std


def fates(records, granularity, lateness, flush_every, align="hour"):
    """One object's records (unit, ts, value) in arrival order -> (closed windows as
    (start, place of closing, members), late records as (place, start, phase), open windows)."""
    lat, size, every = lateness * MIN, granularity * MIN, flush_every * MIN
    ts = [r[1] for r in records]
    clock = [max(ts[:i + 1]) for i in range(len(ts))]
    on_time = [i == 0 or ts[i] >= clock[i - 1] - lat for i in range(len(ts))]
    cleanups, since = [], ts[0]
    for i in range(len(ts)):
        if on_time[i] and clock[i] - since >= every:
            cleanups.append(i)
            since = clock[i]
    start = [window_of(t, granularity, align) for t in ts]
    never = len(ts)
    shut = {w: next((i for i in cleanups if clock[i] >= w + size + lat), never) for w in set(start)}
    born = {w: next((i for i in range(len(ts)) if on_time[i] and start[i] == w), never) for w in set(start)}
    member = [on_time[i] or born[start[i]] < i < shut[start[i]] for i in range(len(ts))]
    closed, open_, late = [], [], []
    for w in sorted(set(start)):
        inside = [i for i in range(len(ts)) if start[i] == w and member[i]]
        if inside:
            (closed if shut[w] < never else open_).append((w, shut[w], inside))
    for i in range(len(ts)):
        if not member[i]:
            late.append((i, start[i], 2 if born[start[i]] < i else 0))
    return closed, late, open_


def fold_emissions(records, granularity, lateness, flush_every, align="hour", flush_end=False):
    """records: (object_id, unit, ts_ms, value, arr_major, arr_minor) in any order.  Emissions
    (object, start, kind, phase, count .. std, arr_major, arr_minor) in the order they happen."""
    by_obj = {}
    for r in sorted(records, key=lambda r: (r[0], r[4], r[5])):
        by_obj.setdefault(r[0], []).append(r)
    out = []
    for obj, rs in by_obj.items():
        rows = [(r[1], r[2], r[3]) for r in rs]
        closed, late, open_ = fates(rows, granularity, lateness, flush_every, align)
        happen = [((at, w), (obj, w, "closed", 1, *stats([rows[i] for i in inside]), None, None)) for w, at, inside in closed]
        happen += [((i, w), (obj, w, "late", phase, *stats([rows[i]]), rs[i][4], rs[i][5])) for i, w, phase in late]
        out += [e for _, e in sorted(happen, key=lambda x: x[0])]
        if flush_end:
            out += [(obj, w, "closed", 1, *stats([rows[i] for i in inside]), None, None) for w, _, inside in open_]
    return out


def sink_apply(table: dict, emissions):
    """Apply emissions one by one with the read-compare-write rules.  ``table`` maps
    (object_id, ws_ms) -> dict row; emissions as produced by ``fold_emissions``.
    Returns action counters."""
    acts = dict(rec_normal=0, rec_late=0, rec_late_first=0, rec_late_update=0,
                rec_override=0, rec_skip=0)
    for e in emissions:
        (obj, ws, kind, phase, n, s, mn, mx, mean, last, last_ts, k, ks, ks2, std, _, _) = e
        row = dict(count=n, sum=s, min=mn, max=mx, mean=mean, last=last, last_ts=last_ts,
                   k=k, k_sum=ks, k_sum_2=ks2, std=std)
        key = (obj, ws)
        old = table.get(key)
        if old is not None:
            if kind == "late":
                acts["rec_late"] += 1
                acts["rec_late_update"] += 1
                v, ts = last, last_ts
                old["min"] = min(old["min"], v)
                old["max"] = max(old["max"], v)
                old["count"] += 1
                old["sum"] += v
                if old["last_ts"] < ts:
                    old["last"], old["last_ts"] = v, ts
                if old["k"] is not None:
                    d = v - old["k"]
                    old["k_sum"] += d
                    old["k_sum_2"] += d * d
                    var = (old["k_sum_2"] - old["k_sum"] ** 2 / old["count"]) / old["count"]
                    old["std"] = math.sqrt(max(var, 0.0))
                old["mean"] = old["sum"] / old["count"]
            elif old["count"] < n:
                acts["rec_override"] += 1
                table[key] = row
            else:
                acts["rec_skip"] += 1
        else:
            if kind == "late":
                acts["rec_late"] += 1
                acts["rec_late_first"] += 1
            else:
                acts["rec_normal"] += 1
            table[key] = row
    return acts
