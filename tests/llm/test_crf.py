import itertools

import numpy as np

from clockroll.llm import crf_toxicity as C, queries as Q

SF01, SF1 = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(0)
    for n in (1, 2, 5, 12):
        e, trans, first = r.normal(size=n) * 2, r.normal(size=(2, 2)), np.zeros(n, bool)
        first[0] = True
        first[n // 2] = True
        weight, total, pairs = np.zeros(n), 0.0, np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=n):
            s = np.exp(sum(e[t] * y[t] for t in range(n)) + sum(trans[y[t - 1], y[t]] for t in range(1, n) if not first[t]))
            total += s
            weight += s * np.array(y)
            for t in range(1, n):
                if not first[t]:
                    pairs[y[t - 1], y[t]] += s
        p, q = C.forward_backward(e, first, trans)
        assert np.allclose(p, weight / total) and np.allclose(q, pairs / total)


def test_long_chain_equals_plain_recursion():
    r = np.random.default_rng(1)
    n = 5000
    e, trans, first = r.normal(size=n) * 3, r.normal(size=(2, 2)), r.random(n) < 0.01
    first[0] = True
    p = C.marginals(e, first, trans)
    a = np.zeros((n, 2))
    b = np.zeros((n, 2))
    w = np.exp(trans)
    for t in range(n):
        a[t] = [1, np.exp(e[t])] if first[t] else (a[t - 1] @ w) * [1, np.exp(e[t])]
        a[t] /= a[t].sum()
    for t in range(n - 1, -1, -1):
        b[t] = 1 if t == n - 1 or first[t + 1] else w @ (np.array([1, np.exp(e[t + 1])]) * b[t + 1])
        b[t] /= b[t].sum()
    want = a[:, 1] * b[:, 1] / (a * b).sum(axis=1)
    assert np.allclose(p, want, atol=1e-9)


def test_held_out(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF1}/labels.parquet").collect()}
    out = [(labels[r.doc_id], r.predicted) for r in Q.op4_crf_toxicity(spark, SF1).collect() if r.held_out and r.doc_id in labels]
    hit, toxic = sum(y and p for y, p in out), sum(y for y, _ in out)
    wrong = sum(p and not y for y, p in out)
    assert hit / toxic > 0.85 and wrong / (len(out) - toxic) < 0.04


def test_spans_and_edges(spark, edge_docs, no_docs):
    rows = [(i, "you are an idiot and more" if i % 2 else "a fine day and more", i % 2) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(99, None)], "id long, toxic int")
    model = C.fit(docs, labels)
    df = spark.createDataFrame([(1, "Such an IDIOT!"), (2, "A fine day"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r for r in C.score(df, model).collect()}
    assert got[1].predicted == 1 and "IDIOT" in "Such an IDIOT!"[got[1].spans[0].start:got[1].spans[0].end]
    assert [got[i].predicted for i in (2, 3, 4)] == [0, 0, 0] and got[3].score == got[4].score == 0
    assert C.score(edge_docs, model).count() == 11 and C.score(no_docs, model).count() == 0
    assert C.unoffending(edge_docs, model).columns == edge_docs.columns
    empty = C.fit(docs, labels.where("toxic = 0"))
    assert {r.predicted for r in C.score(df, empty).collect()} == {0}
