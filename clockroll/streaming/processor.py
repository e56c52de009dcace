"""Keyed state for the stream: one :class:`~clockroll.operators.arrivals.Book` per object and granularity.

All granularities of a job share one operator: the source is read and shuffled once, and an object's state
is one map of clocks by granularity and one map of open windows by (granularity, window start).

Runs inside ``groupBy("object_id").transformWithStateInPandas``: Spark hash-partitions the
stream by object, keeps the state in the state store (RocksDB) and checkpoints it with the
offsets.  Per key and micro-batch the open windows (a handful: about lateness/size + 1) are
read once, the batch's records are applied with array operations, and only the windows that
changed are written back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import astuple

import numpy as np
import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from clockroll.functions.units import ADVANCED_UNITS
from clockroll.operators.arrivals import EMITTED, EMITTED_DDL, Book, Rules, Totals

CLOCK_KEY_SCHEMA = StructType([StructField("minutes", IntegerType())])
CLOCK_SCHEMA = StructType([StructField("clock", LongType()), StructField("cleaned", LongType())])
SEEN_SCHEMA = StructType([StructField("seen", LongType())])
WINDOW_KEY_SCHEMA = StructType([StructField("minutes", IntegerType()), StructField("ws_ms", LongType())])
#: What the operator emits: the granularity and an emission.
STREAMED_DDL = "minutes int, " + EMITTED_DDL
WINDOW_DDL = ("n long, total double, low double, high double, last double, last_ts long, k double, "
              "k_sum double, k_sum_2 double")


class WindowProcessor(StatefulProcessor):
    """Per-object windows with lateness, cleanup cadence and (optionally) idle timeouts, for each of ``rules``
    (one per granularity; ``timeouts_ms`` by granularity)."""

    def __init__(self, rules: list[Rules], timeouts_ms: dict[int, int] | None = None, advanced=ADVANCED_UNITS):
        self.rules, self.timeouts, self.advanced = rules, timeouts_ms or {}, frozenset(advanced)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.clocks = handle.getMapState("clocks", CLOCK_KEY_SCHEMA, CLOCK_SCHEMA)
        self.windows = handle.getMapState("windows", WINDOW_KEY_SCHEMA, WINDOW_DDL)
        self.seen = handle.getValueState("seen", SEEN_SCHEMA)

    def _books(self) -> dict[int, Book]:
        books = {r.minutes: Book() for r in self.rules}
        for k, v in self.clocks.iterator():
            if int(k[0]) in books:
                books[int(k[0])].clock, books[int(k[0])].cleaned = v
        for k, v in self.windows.iterator():
            if int(k[0]) in books:
                books[int(k[0])].windows[int(k[1])] = Totals(*v)
        return books

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        obj, books = int(key[0]), self._books()
        parts = list(rows)
        col = lambda c, kind: np.concatenate([p[c].to_numpy(dtype=kind) for p in parts])
        major, minor = col("arr_major", np.int64), col("arr_minor", np.int64)
        order = np.lexsort((minor, major))
        adv = np.array([u in self.advanced for p in parts for u in p["unit"]])
        ts, value = col("ts_ms", np.int64)[order], col("value", np.float64)[order]
        out = []
        for r in self.rules:
            book, g = books[r.minutes], r.minutes
            known = set(book.windows)
            out += [(g, *e) for e in book.take(r, obj, ts, value, adv[order], major[order], minor[order])]
            self.clocks.updateValue((g,), (book.clock, book.cleaned))
            for w in book.touched:
                if w in book.windows:
                    self.windows.updateValue((g, w), astuple(book.windows[w]))
                elif w in known:
                    self.windows.removeKey((g, w))
        if self.timeouts:
            now = timerValues.getCurrentProcessingTimeInMs()
            self.seen.update((now,))
            for t in self.handle.listTimers():
                self.handle.deleteTimer(t)
            for t in sorted(set(self.timeouts.values())):
                self.handle.registerTimer(now + t)
        if out:
            yield _frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Idle timeout: no record for this object for a granularity's timeout: flush its windows."""
        idle = expiredTimerInfo.getExpiryTimeInMs() - self.seen.get()[0]
        out = []
        for g, book in self._books().items():
            if self.timeouts[g] <= idle:
                open_ = list(book.windows)
                out += [(g, *e) for e in book.flush(int(key[0]))]
                for w in open_:
                    self.windows.removeKey((g, w))
        if out:
            yield _frame(out)

    def close(self) -> None:
        pass


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["minutes", *EMITTED])
