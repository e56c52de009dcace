import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from clockroll.llm import jaccard_regions as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs):
    """(doc_id, shingles, component) by comparing all pairs that share a shingle."""
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").translate(LOW))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    own, parent = defaultdict(list), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        hits = Counter(j for g in s for j in own[g])
        for j, n in hits.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for g in s:
            own[g].append(i)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        low[root(i)].append(doc)
    least = {r: min((d for d in ds if d is not None), default=None) for r, ds in low.items()}
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs)), key=str)


def joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.join_components(df).collect()), key=str)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


def test_shingles():
    a, b, c, d, e = J.shingle_sets(["A b  c\td e f", "a b c d e f", "a b", None, "a b\n"])
    assert a.tolist() == b.tolist() and len(a) == 2 and len(c) == 1 and len(d) == 0 and c.tolist() == e.tolist()


@pytest.mark.parametrize("path", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_whole_tables(spark, path):
    docs = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet'").fetchall()
    assert joined(spark.read.parquet(f"{path}/documents.parquet")) == brute(docs)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"e{r.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("wide", [8, 1, 0])
def test_groups_around_the_limit(spark, monkeypatch, wide):
    # Chains of edits near the limit, one passage in all texts, exact copies; small limits force
    # the recursion.
    monkeypatch.setattr(J, "WIDE", wide)
    monkeypatch.setattr(J, "FREQUENT_FROM", 20 if wide else 4)
    r = random.Random(wide)
    passage = [f"p{i}" for i in range(40)]
    docs = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(r.choice([20, 60, 120]))] + passage
        for _ in range(12):
            docs.append(edited(r, base, r.choice([0, 1, 2, 3, 4])))
        base = docs[-1].split()
        docs += [edited(r, base, r.choice([1, 2, 3])) for _ in range(6)]
    docs += [" ".join(passage)] * 3 + [" ".join(f"x{i}y{k}" for k in range(30)) + " " + " ".join(passage) for i in range(40)]
    docs = [(i, t) for i, t in enumerate(docs)]
    r.shuffle(docs)
    assert joined(frame(spark, docs)) == brute(docs)


@pytest.mark.parametrize("wide", [8, 1])
def test_all_links_are_counted(spark, monkeypatch, wide):
    monkeypatch.setattr(J, "WIDE", wide)
    monkeypatch.setattr(J, "FREQUENT_FROM", 20)
    r = random.Random(7)
    docs = [None, "", "one two", "one two", "one two three"]
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(60)]
        docs += [edited(r, base, r.choice([0, 0, 1, 2])) for _ in range(25)]
    docs = list(enumerate(docs))
    sets = [frozenset(x.tolist()) for x in J.shingle_sets([t for _, t in docs])]
    want = [(i, sum(1 for j, y in enumerate(sets) if i != j and x and y and 100 * len(x & y) >= 75 * len(x | y))) for i, x in enumerate(sets)]
    assert max(n for _, n in want) > 5 and 0 < sum(n for _, n in want)
    assert sorted((x.doc_id, x.n_links) for x in J.join_links(frame(spark, docs)).collect()) == want


def test_edges(spark, edge_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in edge_docs.collect()]
    want = [(d, n, d if n == 0 else c) for d, n, c in brute(docs)]
    assert joined(edge_docs) == sorted(want, key=str)
    assert joined(no_docs) == []
    kept = J.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    got = sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect())
    assert got == [(1, ""), (2, ""), (3, "   \n\t "[:5]), (4, "one t"), (6, "word0"), (7, "ÄÖ ü "), (8, "a b c")]
    assert J.one_of_each(no_docs).count() == 0


def test_repeated_rows_leave_one(spark):
    df = spark.createDataFrame([(1, "a b c d e f")] * 5 + [(None, "q r s t u v w")] * 3 + [(2, None)] * 2, "doc_id long, text string")
    assert sorted(str(tuple(r)) for r in J.one_of_each(df).collect()) == ["(1, 'a b c d e f')", "(2, None)", "(2, None)", "(None, 'q r s t u v w')"]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (61, 60), (70, 50)] + [(100, x) for x in range(101, 130)]
    got = {r.node: r.comp for r in J.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[x] for x in range(1, 41)} == {1} and {got[x] for x in (50, 60, 61, 70)} == {50} and got[129] == 100
    assert J.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    import numpy as np

    from clockroll.llm import jaccard_regions as J
    text = " ".join(f"w{i % 977}x{i % 13}" + ("\n" if i % 7 == 0 else "") for i in range(20_000)) + " " + "giant" * 3000 + " end of it all now"
    whole = J.shingle_sets([text])[0]
    monkeypatch.setattr(J, "PIECE", 1000)
    assert np.array_equal(J.shingle_sets([text])[0], whole) and np.array_equal(J.shingle_sets([text, "a b"])[0], whole)


def test_slices_follow_bytes():
    import pyarrow as pa

    from clockroll.llm.common import byte_slices
    b = pa.RecordBatch.from_arrays([pa.array(["x" * 1000, None, "y" * 50_000, "", "z" * 900, "z" * 900])], names=["t"])
    got = [s.num_rows for s in byte_slices(iter([b, b.slice(0, 0)]), 0, 2500)]
    assert got == [2, 1, 3] and sum(got) == b.num_rows


def test_documents_that_only_share_a_passage_are_in_no_region(spark):
    passage = " ".join(f"p{i}" for i in range(50))
    texts = [" ".join(f"d{d}w{i}" for i in range(300)) + " " + passage for d in range(30)]
    copies = [texts[0] + " end", "one two three", "one two three four"]
    src = spark.createDataFrame([(t,) for t in [*texts, *copies]], "text string")
    rows = J._dealt(J.on_workers(src), np.zeros(0, np.uint64)).collect()
    near = {J._class_id(s) for s in J.shingle_sets([texts[0], copies[0]])}
    assert {r.cls for r in rows} == near and {r.pivot for r in rows} == {min(near)}


def test_wide_tables_are_not_broadcast(spark):
    from clockroll.llm.common import sized
    few, many = spark.range(1000), spark.range(60_000)
    hinted = lambda df: "Hint" in df._jdf.queryExecution().logical().toString()
    wide = lambda df: df.select("id", *[(df["id"] + i).alias(q) for i, q in enumerate(J.COARSE)], df["id"].alias("n"))
    assert hinted(sized(few)) and hinted(sized(many)) and hinted(sized(wide(few))) and not hinted(sized(wide(many)))


def test_dealing_that_parts_nothing_is_not_repeated(spark, monkeypatch):
    # Texts of half of 20 passages each: none link, and no order of the shingles parts them.
    monkeypatch.setattr(J, "WIDE", 0)
    times, dealt = [], J._dealt
    monkeypatch.setattr(J, "_dealt", lambda *a: (times.append(1), dealt(*a))[1])
    r = random.Random(5)
    passages = [" ".join(f"b{b}w{i}" for i in range(30)) for b in range(20)]
    docs = [(i, " ".join(passages[b] for b in sorted(r.sample(range(20), 10)))) for i in range(30)]
    assert joined(frame(spark, docs)) == brute(docs) and len(times) == 2


def test_frequent_shingles_are_ranked(spark):
    rows = spark.createDataFrame([(i, i % 7) for i in range(-50, 50)], "s long, c long").repartition(5)
    want = sorted(((-(i % 7), i) for i in range(-50, 50)))
    assert J._hashes(rows).view(np.int64).tolist() == [s for _, s in want]
    assert J._hashes(rows.where("c > 10")).tolist() == []


def test_staged_tables_do_not_have_a_file_for_each_shuffle_partition(spark, monkeypatch):
    import glob
    files, kept = {}, J.staged

    def counted(df, purpose):
        out = kept(df, purpose)
        files[purpose] = max(files.get(purpose, 0), len(glob.glob(out._staged_at.removeprefix("file:") + "/part-*")))
        return out

    monkeypatch.setattr(J, "staged", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = spark.createDataFrame([(i, i + 1) for i in range(200) if i % 10 != 9], "a long, b long")
        got = {r["node"]: r["comp"] for r in J.components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: i - i % 10 for i in range(200)}
    assert {"cc-edges", "cc-labels"} <= set(files) and max(files.values()) <= 3 * spark.sparkContext.defaultParallelism
