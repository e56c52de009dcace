import duckdb
import numpy as np
from pyspark.sql import functions as F

from clockroll.llm import posting_lists as P, queries as Q


def exact(ids, x, q, k):
    s = np.array([(v * x[q]).sum() for v in x])
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), float(s[i])) for i in order]


def test_recall(spark):
    path = "/root/testdata/sf0.1"
    e = duckdb.sql(f"select vec_id, embedding from '{path}/embeddings.parquet' order by vec_id").df()
    ids, x = e.vec_id.to_numpy(), np.array([np.asarray(v, float) for v in e.embedding])
    got = {}
    for r in Q.op10_posting_lists(spark, path).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        want, have = exact(ids, x, q, 20), got[int(ids[q])]
        assert len(have) == 20 and have == sorted(have, key=lambda v: (-v[1], v[0]))
        for v, s in have:
            assert abs(s - float(x[np.searchsorted(ids, v)] @ x[q])) < 1e-12
        hits += len({v for v, _ in want} & {v for v, _ in have})
    assert hits / (20 * len(got)) >= 0.9


def test_graph_finds_the_nearest_centroids():
    c = np.random.default_rng(3).normal(size=(600, 16))
    g = P.CentroidGraph(c)
    found = 0
    for q in np.random.default_rng(4).normal(size=(50, 16)):
        near, d = g.nearest(q, 40)
        true = np.argsort(((c - q) ** 2).sum(1))[:40]
        found += len(set(near.tolist()) & set(true.tolist()))
        assert (np.diff(d) >= 0).all()
    assert found / 2000 > 0.95


def test_lists_are_balanced():
    r = np.random.default_rng(5)
    x = np.concatenate([r.normal(size=(3000, 8)) * 0.05, r.normal(size=(1000, 8))])
    c = P.fit_centroids(x, 32)
    load = np.bincount(P._squares(x, c).argmin(1), minlength=len(c))
    assert load.max() < 12 * len(x) / len(c)


def test_ties_blocks_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ROWS", 16)
    same = [(i, [1.0, 0.0]) for i in range(60)]  # one very common vector
    odd = [(100, None), (101, [0.0, 0.0]), (102, [float("nan"), 1.0]), (103, [1.0, None]), (104, [float("inf"), 1.0]), (105, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [1.0, 0.0])]
    rows = same + odd + [(200 + i, [0.0, float(i + 1)]) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = {}
    for r in P.search(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 20, 40, 200]
    assert got[20] == [(k + 1, v, 1.0) for k, v in enumerate([*range(20)])]
    assert got[0] == [(k + 1, v, 1.0) for k, v in enumerate(range(1, 21))]
    assert [v for _, v, _ in got[200]][:4] == [204, 203, 202, 201]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in P.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 2), (0, 2, 1)]
    assert P.search(few.where("false"), F.col("vec_id") == 0).count() == 0
