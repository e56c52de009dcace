"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays,
personal data gets surrogates, sources are mixed to target weights, texts are encoded.

Each stage reads what its predecessor wrote.  Null and empty texts, null ids, repeated rows and
extra columns pass through the stages as their operators define; an empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from clockroll.llm import budget_mixing, crf_toxicity, jaccard_regions, pii_surrogates, sentencepiece_codec
from clockroll.llm.common import staged
from clockroll.llm.queries import toxicity_model


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return crf_toxicity.unoffending(docs, toxicity_model(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_regions.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_surrogates.replaced(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return budget_mixing.taken(docs)


#: Words that a worker of the encoding keeps: fewer than alone, as the stages before leave executors little memory.
WORDS_KEPT = 50_000


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.roundtrip(docs, public_tokenizers.path("piece_bpe_32k.model"), kept=WORDS_KEPT)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: No SQL expresses the fitted toxicity field or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
