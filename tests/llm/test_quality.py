import re
import zlib

import duckdb

from clockroll.llm import ngram_quality as N, queries as Q

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, twice = set(), set()
    for w in windows:
        (twice if w in seen else seen).add(w)
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "[#*$%&|<>]"[1:-1]), len(lines) - len(set(lines)), len(covered), failed


COLS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(df, trusted):
    docs = df.selectExpr("doc_id as id", "text")
    return N.judge(docs, N.log_ratios(docs, trusted)).collect()


def test_base_rules(spark, edge_docs, no_docs):
    texts = ["a b c d e x a b c d e y z w q", "l1 word\nl1 word\n\n \nl2", "###  $%\x0b&|<> w", "a a a a a a a a a a a a", "x" * 40 + " " + "ab cd ef gh ij " * 50, None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = {i: base(t) for i, t in enumerate(texts)}
    for r in judged(df, df.selectExpr("doc_id as id").where("false")):
        assert tuple(r[c] for c in COLS) == want[r["id"]], r
    whole = edge_docs.collect()
    got = judged(edge_docs, edge_docs.selectExpr("doc_id as id"))
    assert sorted((str(r["id"]), *(r[c] for c in COLS)) for r in got) == sorted((str(r.doc_id), *base(r.text)) for r in whole)
    assert judged(no_docs, no_docs.selectExpr("doc_id as id")) == []


def test_ratios_by_hand(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "id long, text string")
    got = N.log_ratios(df, spark.createDataFrame([(1,), (1,), (None,)], "id long"))
    import math
    n_raw, n_target = 4 + N.BUCKETS, 3 + N.BUCKETS
    for gram, raw, target in (("a", 1, 1), ("a b", 1, 1), ("c", 1, 0), ("zz", 0, 0)):
        want = round((math.log((target + 1) / n_target) - math.log((raw + 1) / n_raw)) * 1e6)
        assert got[zlib.crc32(gram.encode()) % N.BUCKETS] == want


def test_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    want = con.sql(N.SQL).df().sort_values("doc_id").reset_index(drop=True)
    got = Q.op1_ngram_quality(spark, SF001).toPandas().sort_values("doc_id").reset_index(drop=True)
    for c in [*COLS, "kept"]:
        assert (got[c] == want[c]).all(), c


def test_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").selectExpr("doc_id as id", "text")
    plan = N.judge(docs, [0] * N.BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
