"""Operator 3: language identification, words first, character n-grams for unseen words.

For each language the model holds the log frequency of its most frequent words and of its
most frequent character n-grams of each length.  A word that any language's word list knows
is scored by the per-language log frequencies; a word that none knows falls back to its
n-grams of the longest length, and, if none of those is known either, to the next shorter
length.  A list that lacks an entry pays a fixed penalty.  A text's score per language is the
mean over its words; the best language wins, ties go to the name that sorts first.

Fitting counts words and n-grams with Spark over a bounded sample of labelled rows:
``fit_docs`` whole texts per language, taken by hash of the id, and ``list_size`` entries per
language and list.  The model is bounded by these two parameters and the number of languages.

Defined cases: null texts and texts without a letter give ``und`` with score 0; without any
labelled row every text gives ``und``; repeated rows are scored alike; nulls in other columns
have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clockroll.llm.common import on_workers, staged

UNKNOWN = "und"
LENGTHS = (5, 4, 3, 2, 1)
PENALTY = 7.0
WORDS_KEPT = 400_000


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Is the row kept from fitting: crc32 of the id as text, modulo ``parts``, equals ``part``."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == part, F.lit(False))


def fit(labelled: DataFrame, fit_docs: int = 1500, list_size: int = 8000) -> dict:
    """The model of ``labelled`` (id, text, lang)."""
    known = labelled.where("text IS NOT NULL AND lang IS NOT NULL")
    pick = W.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # First within parts of a language, so that no task sees all rows of a frequent one.
    part = W.partitionBy("lang", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(256))).orderBy(F.xxhash64("id"), "id")
    ids = known.select("id", "lang")
    for window in (part, pick):
        ids = ids.withColumn("k", F.row_number().over(window)).where(F.col("k") <= fit_docs).select("id", "lang")
    sample = known.join(F.broadcast(ids), ["id", "lang"], "left_semi").dropDuplicates(["id", "lang"])
    words = (sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("g"))
             .groupBy("lang", "g").agg(F.count("*").alias("c")).select("lang", F.lit(0).alias("n"), "g", "c"))
    words = staged(words, "langid-words")
    padded = F.concat(F.lit(" "), F.col("g"), F.lit(" "))
    grams = None
    for n in LENGTHS:
        at = F.sequence(F.lit(1), F.length(padded) - (n - 1))
        part = words.where(F.length(padded) >= n).select("lang", F.lit(n).alias("n"), F.explode(F.transform(at, lambda i, n=n: F.substring(padded, i, n))).alias("g"), "c")
        grams = part if grams is None else grams.unionByName(part)
    grams = grams.groupBy("lang", "n", "g").agg(F.sum("c").alias("c"))
    lists = words.unionByName(grams)
    sums = W.partitionBy("lang", "n")
    rows = (lists.withColumn("total", F.sum("c").over(sums))
            .withColumn("k", F.row_number().over(sums.orderBy(F.desc("c"), "g"))).where(F.col("k") <= list_size)
            .select("lang", "n", "g", (-F.log10(F.col("c") / F.col("total"))).alias("cost")).toPandas())
    langs = sorted(rows["lang"].unique().tolist())
    place = {x: i for i, x in enumerate(langs)}
    costs: dict[int, dict[str, np.ndarray]] = {}
    for lang, n, g, cost in rows.itertuples(index=False):
        costs.setdefault(int(n), {}).setdefault(g, np.full(len(langs), PENALTY))[place[lang]] = cost
    return {"langs": langs, "costs": costs}


class _Words(dict):
    """Word -> row of its costs; rows of unseen words are made by backing off."""

    def __init__(self, model: dict):
        super().__init__()
        self.costs = model["costs"]
        self.rows = np.full((1 << 12, len(model["langs"])), PENALTY)
        self.floor = np.full(len(model["langs"]), PENALTY)

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at >= len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at] = self._cost(word)
        self[word] = at
        return at

    def _cost(self, word: str) -> np.ndarray:
        if (known := self.costs.get(0, {}).get(word)) is not None:
            return known
        padded = f" {word} "
        for n in LENGTHS:
            grams = self.costs.get(n)
            if grams:
                found = [x for i in range(len(padded) - n + 1) if (x := grams.get(padded[i:i + n])) is not None]
                if found:
                    missing = len(padded) - n + 1 - len(found)
                    return (np.sum(found, axis=0) + missing * self.floor) / (len(found) + missing)
        return self.floor


_built: list = []
_LETTERS = regex.compile(r"\p{L}+")


def _predict_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _built or _built[0] is not shared:
            _built[:] = [shared, _Words(shared.value)]
        table, langs = _built[1], shared.value["langs"]
        for b in batches:
            names, scores = [], []
            for text in b.column(1).to_pylist():
                words = _LETTERS.findall(text.lower()) if text else []
                if not words or not langs:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                if len(table) > WORDS_KEPT:
                    table = _built[1] = _Words(shared.value)
                at = [table[w] for w in words]
                cost = table.rows[at].mean(axis=0)
                best = int(cost.argmin())
                # Chance of the best language if each of at most 16 words counted for itself.
                odds = 10.0 ** np.clip((cost[best] - cost) * min(len(words), 16), -300, 0)
                names.append(langs[best])
                scores.append(float(1 / odds.sum()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
    return run


def predict(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every text."""
    shared = on_workers(df).sparkSession.sparkContext.broadcast(model)
    src = df.select(df[f"`{id_col}`"].alias("doc_id"), df[f"`{text_col}`"].alias("text"))
    return src.mapInArrow(_predict_batches(shared), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")
