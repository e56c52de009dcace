from fractions import Fraction

import duckdb
import pytest

from clockroll.llm import budget_mixing as M, queries as Q

SF01 = "/root/testdata/sf0.01"


def shares(total, nodes):
    """Water filling by definition: name -> (weight, capacity)."""
    out, open_, left = {}, dict(nodes), Fraction(total)
    while open_:
        level = left / sum(w for w, _ in open_.values())
        full = {n: c for n, (w, c) in open_.items() if c <= level * w}
        if not full:
            return out | {n: int(level * w) for n, (w, _) in open_.items()}
        out |= full
        left -= sum(full.values())
        open_ = {n: x for n, x in open_.items() if n not in full}
    return out


def test_budgets_go_to_siblings_before_ancestors(spark):
    rows = [("web", "en", "a", 1000), ("web", "en", "b", 10), ("web", "de", "c", 5), ("books", "en", "d", 50), ("forum", "fr", "e", 4000), ("other", "und", "f", 7)]
    leaves = spark.createDataFrame([(*r, 1) for r in rows], "domain string, lang string, source string, tokens long, n_docs long")
    got = {(r.domain, r.lang, r.source): r.a for r in M.budgets(leaves, 3000, 2).collect()}
    weight = lambda table, x: table.get(x, M.DEFAULT_WEIGHT)
    cap = lambda *path: sum(2 * r[3] for r in rows if r[:len(path)] == path)
    want = {}
    doms = shares(3000, {d: (weight(M.DOMAIN_WEIGHTS, d), cap(d)) for d in {r[0] for r in rows}})
    for d, a in doms.items():
        langs = shares(a, {x: (weight(M.LANG_WEIGHTS, x), cap(d, x)) for x in {r[1] for r in rows if r[0] == d}})
        for x, b in langs.items():
            for s, c in shares(b, {r[2]: (M.SOURCE_WEIGHT, cap(d, x, r[2])) for r in rows if r[:2] == (d, x)}).items():
                want[d, x, s] = c
    assert got == want
    assert got["web", "en", "b"] == 20 and got["web", "de", "c"] == 10  # full; the rest stayed in web / en
    assert {k: v for k, v in ((r.source, r.a) for r in M.budgets(leaves, 10**9, 2).collect())} == {r[2]: 2 * r[3] for r in rows}


@pytest.mark.parametrize("cell", [4096, 3])
def test_equals_sql(spark, monkeypatch, cell):
    monkeypatch.setattr(M, "CELL_DOCS", cell)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF01}/documents.parquet'")
    want = sorted(con.sql(f"select doc_id, n_tokens, copies from ({M.sql()})").fetchall())
    got = sorted(map(tuple, Q.op5_budget_mixing(spark, SF01).select("doc_id", "n_tokens", "copies").collect()))
    assert got == want
    assert len({c for _, _, c in got}) > 2


def test_tables_of_a_mixture_are_written_in_few_files(spark, monkeypatch):
    files, kept = {}, M.staged

    def counted(df, purpose):
        out = kept(df, purpose)
        files[purpose] = len(out.inputFiles())
        return out
    monkeypatch.setattr(M, "staged", counted)
    most = 3 * spark.sparkContext.defaultParallelism
    docs = spark.range(2000).selectExpr("id AS doc_id", "repeat('word ', int(id % 9)) AS text", "concat('l', id % 7) AS lang", "concat('src', id % 40) AS source").repartition(2 * most)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 2 * most)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert M.mixed(docs, 3000).count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert set(files) == {"mix-plan", "mix-edge", "mix-docs", "mix-cuts"} and max(files.values()) <= most


def test_edges(spark, edge_docs, no_docs):
    out = M.mixed(edge_docs)
    assert out.columns == [*edge_docs.columns, "domain", "n_tokens", "_copies"] and out.count() == 11
    kept = M.taken(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["_copies"] for r in out.collect())
    assert M.mixed(no_docs).count() == 0 and M.taken(no_docs).count() == 0
    repeated = {(r.doc_id, r.text): set() for r in out.collect()}
    for r in out.collect():
        repeated[r.doc_id, r.text].add(r["_copies"])
    assert all(len(x) == 1 for x in repeated.values())
