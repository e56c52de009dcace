"""A book of one object, over runs of any length, equals the definition."""

import random
import time

import numpy as np
import pytest

from clockroll.operators.arrivals import Book, Rules
from tests.reference_fold import MIN, fates, stats

T0 = 1704067200000


def records(rnd, n, t_from):
    recs = []
    for i in range(n):
        ts = t_from + rnd.randrange(0, 6 * 3600_000)
        if rnd.random() < 0.3:
            ts -= ts % 60_000  # equal timestamps
        delay = rnd.choice([0, 0, rnd.randrange(0, 2 * 3600_000)])
        recs.append((ts + delay, i, rnd.choice(["V", "lx"]), ts, round(rnd.uniform(-5, 50), 2)))
    return [(u, ts, v) for _, _, u, ts, v in sorted(recs)]


def take(book, rules, recs, first=0):
    at = np.arange(first, first + len(recs))
    return book.take(rules, 1, np.array([r[1] for r in recs]), np.array([r[2] for r in recs]),
                     np.array([r[0] == "V" for r in recs]), at, np.zeros(len(recs), dtype=np.int64))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[-2], r[1]))


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(ordered(got), ordered(want), strict=True):
        assert a[:3] == b[:3] and a[-2:] == b[-2:]
        assert [x is None for x in a] == [x is None for x in b]
        assert [x for x in a[3:] if x is not None] == pytest.approx([x for x in b[3:] if x is not None], abs=1e-6)


@pytest.mark.parametrize("seed,g,lat,fe", [(s, *c) for s in range(5) for c in [(15, 5, 0), (60, 30, 0), (60, 30, 2), (25, 0, 7), (1440, 10, 0), (5, 1, 1)]])
def test_equals_the_definition(seed, g, lat, fe):
    rnd = random.Random(seed * 100 + g + fe)
    recs, rules = records(rnd, 300, T0), Rules(g, lat * MIN, fe * MIN)
    closed, late, open_ = fates(recs, g, lat, fe)
    want = ([(1, w, "closed", *stats([recs[i] for i in inside]), at, 0) for w, at, inside in closed]
                   + [(1, w, "late", *stats([recs[i]]), i, 0) for i, w, _ in late])
    for cut in ([], [1], [100, 101, 180], list(range(1, 300))):
        book, out, lo = Book(), [], 0
        for hi in [*cut, len(recs)]:
            out += take(book, rules, recs[lo:hi], lo)
            lo = hi
        same([(*e[:3], *e[4:]) for e in out], want)
        if not cut:
            assert sorted(e[3] for e in out if e[2] == "late") == sorted(p for _, _, p in late)
        left = [(w, x.n, round(x.total, 6)) for w, x in sorted(book.windows.items())]
        assert left == [(w, len(inside), round(sum(recs[i][2] for i in inside), 6)) for w, _, inside in open_]


def test_cost_of_a_small_run():
    rules, recs = Rules(60, 30 * MIN, 2 * MIN), records(random.Random(1), 12, T0)
    times = []
    for _ in range(300):
        book = Book()
        begin = time.perf_counter()
        take(book, rules, recs)
        times.append(time.perf_counter() - begin)
    assert sorted(times)[len(times) // 2] < 0.001
