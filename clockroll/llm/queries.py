"""The registered queries of the numbered operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clockroll.llm import budget_mixing, crf_toxicity, dac_tokens, jaccard_regions, ngram_quality, pii_surrogates, posting_lists, rtree_negatives, sentencepiece_codec, spelling_fst, two_pass_shuffle, warc_index, word_backoff_langid as langid
from clockroll.session import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("id"))
    judged = ngram_quality.judge(docs, ngram_quality.log_ratios(docs, trusted))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replaced(_table(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op5_budget_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = budget_mixing.mixed(docs)
    return out.select("doc_id", "domain", F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("source", F.lit("unknown")).alias("source"), "n_tokens", "copies")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_codec.digests(sentencepiece_codec.roundtrip(docs, public_tokenizers.path("piece_bpe_32k.model")))


def op7_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _table(spark, sf_dir, "documents"), scratch_dir(spark, "dac") + "/files"
    dac_tokens.write(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return dac_tokens.digests(dac_tokens.read_documents(spark, path))


def op8_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = _table(spark, sf_dir, "documents"), scratch_dir(spark, "shards") + "/shards"
    two_pass_shuffle.write_shards(docs, path, n_shards=24)
    return two_pass_shuffle.digests(two_pass_shuffle.read_shards(spark, path, docs))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    apart = langid.held_out(F.col("doc_id"), 3, 1)
    model = langid.fit(docs.where(~apart).select(F.col("doc_id").alias("id"), "text", "lang"))
    return langid.predict(docs, model).withColumn("held_out", apart).select("doc_id", "held_out", "lang_pred", "score")


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict:
    """The field fitted on labelled rows that are not held out."""
    labels = _table(spark, sf_dir, "labels").where(~langid.held_out(F.col("doc_id"), 4, 2))
    return crf_toxicity.fit(docs.select(F.col("doc_id").alias("id"), "text"), labels.select(F.col("doc_id").alias("id"), "toxic"))


def op4_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = crf_toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select("doc_id", langid.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted", "spans")


def op9_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_regions.join_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


def op10_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op11_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc") + "/pages"
    index = warc_index.write(_table(spark, sf_dir, "pages"), path)
    return warc_index.digests(warc_index.read(index, path, payload=False))


def op12_rtree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rtree_negatives.usable(_table(spark, sf_dir, "embeddings"))
    rows = rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return rtree_negatives.mine(rows, F.col("id") % 100 == 0)


def op13_spelling_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_fst.variants(spelling_fst.vocabulary(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_quality": op1_ngram_quality,
    "op2_pii_surrogates": op2_pii_surrogates,
    "op3_langid": op3_langid,
    "op4_crf_toxicity": op4_crf_toxicity,
    "op5_budget_mixing": op5_budget_mixing,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_dac_tokens": op7_dac_tokens,
    "op8_two_pass_shuffle": op8_two_pass_shuffle,
    "op9_jaccard_regions": op9_jaccard_regions,
    "op10_posting_lists": op10_posting_lists,
    "op11_warc_index": op11_warc_index,
    "op12_rtree_negatives": op12_rtree_negatives,
    "op13_spelling_fst": op13_spelling_fst,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_quality": ngram_quality.SQL,
    "op5_budget_mixing": budget_mixing.sql(),
    "op11_warc_index": warc_index.SQL,
    "op12_rtree_negatives": rtree_negatives.SQL,
}
