import numpy as np
import pytest
from pyspark.sql import functions as F

from clockroll.llm import rtree_negatives as t

SCHEMA = "vec_id long, label int, embedding array<float>, ids binary, n int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1) for r in rows], SCHEMA)


def _brute(rows, every, k=5, percent=80):
    """(anchor, positive, rank, negative, scores) by comparing all rows."""
    ok = [(i, lab, tuple(v)) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ok = list(dict.fromkeys(ok))
    width = max((len(v) for _, _, v in ok), default=0)
    whole = [[int(np.floor(256.0 * float(np.float32(x)))) for x in v] + [0] * (width - len(v)) for _, _, v in ok]
    out = []
    for a, (i, lab, _) in enumerate(ok):
        if i % every:
            continue
        scored = [(-sum(x * y for x, y in zip(whole[a], whole[b], strict=True)), j, m) for b, (j, m, _) in enumerate(ok) if j != i]
        for s, p, _ in sorted(x for x in scored if x[2] == lab)[:k]:
            fit = sorted(x for x in scored if x[2] != lab and percent * -s <= 100 * -x[0] <= 100 * -s)[:k]
            out += [(i, p, r, n, -s, -m) for r, (m, n, _) in enumerate(fit, 1)]
    return sorted(out)


def _mined(df, every):
    return sorted(map(tuple, t.mine(t.usable(df), F.col("id") % every == 0).collect()))


@pytest.mark.parametrize("seed,n,dim,labels,part", [(1, 700, 8, 3, 100), (2, 900, 3, 2, 10_000), (3, 500, 16, 4, 60)])
def test_same_as_comparing_all_rows(spark, monkeypatch, seed, n, dim, labels, part):
    monkeypatch.setattr(t, "PART_ROWS", part)
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(labels)), (rng.normal(size=dim) + 0.4).round(2).tolist()) for i in range(n)]
    # one vector held by a third of the rows, in all labels: ties by the hundred
    rows += [(n + i, int(rng.integers(labels)), rows[5][2]) for i in range(n // 2)]
    assert _mined(_table(spark, rows), 25) == _brute(rows, 25)


def test_defined_cases(spark):
    nan = float("nan")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (0, 2, [0.5]), (1, 1, [1.0, 1.0]), (1, 1, [1.0, 1.0]), (2, 2, [1.0, 1.0]), (3, 2, [0.9, 1.0, 0.1]),
            (None, 1, [9.0, 9.0]), (4, None, [9.0, 9.0]), (5, 2, None), (6, 2, [nan, 1.0]), (7, 2, [None, 1.0]), (8, 2, [float("inf"), 1.0]), (9, 2, []),
            (10, 1, [-1.0, -2.0]), (20, 3, [1e15, 1e15]), (21, 2, [1.0, 1.0])]
    small = [r for r in rows if r[0] != 20]
    assert _mined(_table(spark, small), 10) == _brute(small, 10)
    assert _mined(_table(spark, []), 10) == []
    assert _mined(_table(spark, [(0, 1, [1.0])]), 10) == []


def test_sums_beyond_double_precision_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, i % 2, (rng.integers(1, 1 << 16, 4) * 16.0 + rng.integers(0, 2, 4) / 256).tolist()) for i in range(120)]
    assert _mined(_table(spark, rows), 10) == _brute(rows, 10)


def test_boxes_bound_their_rows():
    rng = np.random.default_rng(7)
    x, q = np.floor(256 * rng.normal(size=(1000, 6))), np.floor(256 * rng.normal(size=(5, 6)))
    leaves = t.str_order(x)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000)) and max(map(len, leaves)) <= t.LEAF
    tree = t.Tree(np.stack([x[a].min(0) for a in leaves]), np.stack([x[a].max(0) for a in leaves]), np.array([a.min() for a in leaves]), leaves, [x[a] for a in leaves])
    lo, hi = t.intervals(q, tree.low, tree.high)
    for k, a in enumerate(leaves):
        s = q @ x[a].T
        assert (s.min(axis=1) >= lo[:, k]).all() and (s.max(axis=1) <= hi[:, k]).all()
    for node, kids in tree.children.items():
        assert (tree.low[node] == tree.low[list(kids)].min(0)).all() and (tree.high[node] == tree.high[list(kids)].max(0)).all()


def test_clustered_rows_are_pruned(monkeypatch):
    """With vectors in clusters most leaves are never scored."""
    rng = np.random.default_rng(8)
    x = np.concatenate([np.floor(256 * (c + 0.05 * rng.normal(size=(400, 8)))) for c in rng.normal(size=(30, 8))])
    leaves = t.str_order(x)
    scored = []

    class Counted(list):
        def __getitem__(self, k):
            scored.append(k)
            return super().__getitem__(k)
    tree = t.Tree(np.stack([x[a].min(0) for a in leaves]), np.stack([x[a].max(0) for a in leaves]), np.array([a.min() for a in leaves]), leaves, Counted(x[a] for a in leaves))
    for a in range(0, len(x), 600):
        lo, hi = t.intervals(x[a:a + 1], tree.low, tree.high)
        w = t.Window(5)
        t.descend(tree, x[a], a, lo[0].tolist(), hi[0].tolist(), [w])
        s = x @ x[a]
        s[a] = -np.inf
        assert [-b for b, _ in w.best] == np.sort(s)[::-1][:5].tolist()
    assert len(scored) < 0.3 * len(leaves) * 20
