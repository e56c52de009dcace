"""The rules of one object's clock and windows, stated once over arrays.

A :class:`Book` is what is kept of an object between two runs of its records: its clock, the
clock at its last cleanup and its open windows.  ``Book.take`` applies a run of records that is
already in arrival order and returns the emissions:

* the clock is the greatest timestamp so far; a record is on time if it is at most the lateness
  behind the clock before it;
* a cleanup happens at the first on-time record that finds the clock ``flush_every`` beyond the
  previous cleanup, and closes every window that the clock has passed by size + lateness;
* a window opens with its first on-time record; a late record belongs to it while it is open and
  is emitted alone otherwise.

The stream operator keeps a book in keyed state; the batch operator keeps one while an object's
sorted records pass by.  The cost of a run is a fixed number of array operations plus one step
per cleanup and per window touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np

HOUR = 3_600_000
MINUTE = 60_000

#: Columns of an emission before the target keys are added.  ``arr_*`` is the arrival of a late
#: record, or of the record whose cleanup closed the window.
EMITTED = ("object_id", "ws_ms", "kind", "phase", "count", "sum", "min", "max", "mean", "last",
           "last_ts", "k", "k_sum", "k_sum_2", "std", "arr_major", "arr_minor")
EMITTED_DDL = ("object_id int, ws_ms long, kind string, phase int, count long, sum double, min double, max double, "
               "mean double, last double, last_ts long, k double, k_sum double, k_sum_2 double, std double, "
               "arr_major long, arr_minor long")
LATE_BEFORE, CLOSED, LATE_AFTER = 0, 1, 2
assert tuple(c.split()[0] for c in EMITTED_DDL.split(", ")) == EMITTED


@dataclass(frozen=True)
class Rules:
    minutes: int
    lateness_ms: int
    flush_every_ms: int
    align: str = "hour"

    @property
    def hold_ms(self) -> int:
        """How far the clock must pass a window's start for the window to be due."""
        return self.minutes * MINUTE + self.lateness_ms

    def starts(self, ts: np.ndarray) -> np.ndarray:
        if self.align == "epoch":
            return ts - ts % (self.minutes * MINUTE)
        within = ts % HOUR
        return ts - within + within // MINUTE // self.minutes * self.minutes * MINUTE

    @classmethod
    def of(cls, cfg) -> "Rules":
        return cls(cfg.granularity, cfg.lateness_ms, cfg.flush_every_ms, cfg.align)


@dataclass
class Totals:
    """Statistics of a window; ``k`` is None for units without a deviation."""
    n: int
    total: float
    low: float
    high: float
    last: float
    last_ts: int
    k: float | None
    k_sum: float | None
    k_sum_2: float | None

    def plus(self, other: "Totals") -> "Totals":
        """With the statistics of records that arrived later and share this window's ``k``."""
        newer = other.last_ts > self.last_ts
        add = lambda a, b: None if a is None else a + b
        return Totals(self.n + other.n, self.total + other.total, min(self.low, other.low), max(self.high, other.high),
                      other.last if newer else self.last, other.last_ts if newer else self.last_ts,
                      self.k, add(self.k_sum, other.k_sum), add(self.k_sum_2, other.k_sum_2))

    def emission(self, obj: int, start: int, kind: str, phase: int, arrival: tuple) -> tuple:
        std = None
        if self.k is not None:
            std = math.sqrt(max((self.k_sum_2 - self.k_sum ** 2 / self.n) / self.n, 0.0))
        return (obj, start, kind, phase, self.n, self.total, self.low, self.high, self.total / self.n,
                self.last, self.last_ts, self.k, self.k_sum, self.k_sum_2, std, *arrival)


def _late_alone(obj, start, ts, value, adv, phase, arrival) -> tuple:
    k, zero = (value, 0.0) if adv else (None, None)
    # a timestamp at or before the epoch never becomes the last one
    last, last_ts = (value, ts) if ts > 0 else (0.0, 0)
    return Totals(1, value, value, value, last, last_ts, k, zero, zero).emission(obj, start, "late", phase, arrival)


@dataclass
class Book:
    clock: int | None = None
    cleaned: int | None = None
    windows: dict[int, Totals] = field(default_factory=dict)
    touched: set[int] = field(default_factory=set)  # windows changed or closed by the last run

    def _cleanups(self, rules: Rules, on_time: np.ndarray, clocks: np.ndarray) -> np.ndarray:
        """Places of the records at which a cleanup happens."""
        places = np.flatnonzero(on_time)
        if not rules.flush_every_ms:
            return places
        seen, picked, at = clocks[places], [], self.cleaned
        while (k := int(np.searchsorted(seen, at + rules.flush_every_ms))) < len(places):
            picked.append(places[k])
            at = int(seen[k])
        return np.array(picked, dtype=np.int64)

    def take(self, rules: Rules, obj: int, ts: np.ndarray, value: np.ndarray, adv: np.ndarray,
             major: np.ndarray, minor: np.ndarray) -> list[tuple]:
        n = len(ts)
        self.touched = set()
        if not n:
            return []
        if self.clock is None:
            self.clock = self.cleaned = int(ts[0])
        clocks = np.maximum(np.maximum.accumulate(ts), self.clock)
        before = np.empty(n, dtype=np.int64)
        before[0], before[1:] = self.clock, clocks[:-1]
        on_time = ts >= before - rules.lateness_ms
        points = self._cleanups(rules, on_time, clocks)
        due = clocks[points]

        # records grouped by window, each group in arrival order
        start = rules.starts(ts)
        order = np.argsort(start, kind="stable")
        grouped = start[order]
        at = np.flatnonzero(np.concatenate(([True], grouped[1:] != grouped[:-1])))
        size = np.diff(np.append(at, n))
        keys = grouped[at]
        held = np.array([int(w) in self.windows for w in keys])
        opened = np.where(held, -1, np.minimum.reduceat(np.where(on_time[order], order, n), at))
        k = np.searchsorted(due, keys + rules.hold_ms)
        closing = np.append(points, n)[k]
        spread = lambda x: np.repeat(x, size)
        inside = on_time[order] | ((spread(opened) < order) & (order < spread(closing)))

        self._fold(keys, at, size, order, inside, ts, value, adv)
        self.clock = int(clocks[-1])
        if len(points):
            self.cleaned = int(due[-1])
        out = self._close(rules, obj, points, due, n, major, minor)
        if not inside.all():
            after = (spread(opened) < order) & (spread(closing) < order)
            for i, phase, w in zip(order[~inside].tolist(), np.where(after, LATE_AFTER, LATE_BEFORE)[~inside].tolist(), grouped[~inside].tolist(), strict=True):
                out.append(_late_alone(obj, w, int(ts[i]), float(value[i]), bool(adv[i]), phase, (int(major[i]), int(minor[i]))))
        return out

    def _fold(self, keys, at, size, order, inside, ts, value, adv) -> None:
        """Add the records that lie inside their windows to the open windows."""
        n, v, t = len(order), value[order], ts[order]
        count = np.add.reduceat(inside.astype(np.int64), at)
        if not count.any():
            return
        each = np.arange(n)
        first = np.minimum.reduceat(np.where(inside, each, n - 1), at)
        lead = np.where(inside, t, np.iinfo(np.int64).min)
        newest = np.maximum.reduceat(lead, at)
        last = np.minimum.reduceat(np.where(lead == np.repeat(newest, size), each, n - 1), at)
        known = [self.windows.get(int(w)) for w in keys]
        base = np.array([v[f] if x is None or x.k is None else x.k for x, f in zip(known, first, strict=True)])
        d = np.where(inside, v - np.repeat(base, size), 0.0)
        sums = np.add.reduceat(np.where(inside, v, 0.0), at)
        low = np.minimum.reduceat(np.where(inside, v, np.inf), at)
        high = np.maximum.reduceat(np.where(inside, v, -np.inf), at)
        ks, ks2 = np.add.reduceat(d, at), np.add.reduceat(d * d, at)
        for j in np.flatnonzero(count).tolist():
            w, x = int(keys[j]), known[j]
            has_k = bool(adv[order[first[j]]]) if x is None else x.k is not None
            positive = newest[j] > 0
            run = Totals(int(count[j]), float(sums[j]), float(low[j]), float(high[j]), float(v[last[j]]) if positive else 0.0, int(newest[j]) if positive else 0,
                         float(base[j]) if has_k else None, float(ks[j]) if has_k else None, float(ks2[j]) if has_k else None)
            self.windows[w] = run if x is None else x.plus(run)
            self.touched.add(w)

    def _close(self, rules, obj, points, due, n, major, minor) -> list[tuple]:
        if not len(points):
            return []
        out = []
        for w in sorted(w for w in self.windows if w + rules.hold_ms <= due[-1]):
            i = int(points[np.searchsorted(due, w + rules.hold_ms)])
            out.append((i, self.windows.pop(w).emission(obj, w, "closed", CLOSED, (int(major[i]), int(minor[i])))))
            self.touched.add(w)
        return [e for _, e in sorted(out, key=lambda x: (x[0], x[1][1]))]

    def flush(self, obj: int) -> list[tuple]:
        """Close every open window, earliest first (idle timeout, end of input)."""
        out = [self.windows[w].emission(obj, w, "closed", CLOSED, (None, None)) for w in sorted(self.windows)]
        self.windows.clear()
        return out
