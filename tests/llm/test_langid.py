from clockroll.llm import queries as Q, word_backoff_langid as L

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    out = [r for r in Q.op3_langid(spark, SF01).collect() if r.held_out and lang[r.doc_id]]
    assert len(out) > 200
    assert sum(r.lang_pred == lang[r.doc_id] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_backoff(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat sat on the mat", "en"), ("the dog ran", "en"), ("der hund lief durch den wald", "de"), ("die katze", "de"), (None, "fr"), ("x", None)])]
    model = L.fit(spark.createDataFrame(rows, "id long, text string, lang string"))
    assert model["langs"] == ["de", "en"]
    words = L._Words(model)
    assert words.rows[words["the"]].argmin() == 1  # a known word
    unseen = words._cost("hundes")
    assert unseen.argmin() == 0 and unseen.min() < L.PENALTY  # by its n-grams
    df = spark.createDataFrame([(1, None), (2, ""), (3, "123 !"), (4, "THE CAT"), (4, "THE CAT"), (5, "die hunde")], "doc_id long, text string")
    got = sorted((r.doc_id, r.lang_pred) for r in L.predict(df, model).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")]


def test_no_training_rows(spark, edge_docs, no_docs):
    model = L.fit(no_docs.selectExpr("doc_id as id", "text", "lang"))
    assert {r.lang_pred for r in L.predict(edge_docs, model).collect()} == {"und"}
    assert L.predict(no_docs, model).count() == 0
