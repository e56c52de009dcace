import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as C
from clockroll.llm import common
from clockroll.llm.common import staged
from clockroll.llm.queries import toxicity_model

SF001 = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    for name, stage in C.STAGES:
        out = staged(stage(spark, docs, SF001), f"test-{name}")
        if name != "encoding":
            assert out.columns == docs.columns
        assert out.count() > 0
        docs = out
    assert C.run(spark, SF001).count() == docs.count()


def test_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in C.STAGES:
            out = staged(stage(spark, docs, SF001), f"edge-{name}")
            if name != "encoding":
                assert out.columns == docs.columns
                docs = out
    assert docs.count() == 0


def test_batches_of_workers_are_bounded_by_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "mb": [b.nbytes >> 20]})
    texts = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    got = common.on_workers(texts).mapInArrow(sizes, "rows long, mb long").collect()
    assert sum(r.rows for r in got) == 3000 and max(r.mb for r in got) <= 2 * common.BATCH_BYTES >> 20


def test_arrow_gives_memory_back_after_each_batch(monkeypatch):
    given = []
    monkeypatch.setattr(common, "spare", lambda: given.append(1))
    batches = [pa.RecordBatch.from_pydict({"t": ["a", None, "b" * 200]}) for _ in range(3)]
    got = [r["t"] for s in common.byte_slices(iter(batches), 0, 100) for r in s.to_pylist()]
    assert got == ["a", None, "b" * 200] * 3 and len(given) == 3


def test_a_toxicity_model_starts_no_rdd_workers(spark, monkeypatch):
    def refused(*args, **kinds):
        raise AssertionError("rows went through an RDD")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    sf01 = "/root/testdata/sf0.01"
    assert toxicity_model(spark, spark.read.parquet(f"{sf01}/documents.parquet"), sf01)
