"""Operator 4: toxic spans by a linear-chain conditional random field, and document scores.

Each word of a text is a token with the labels clean (0) and toxic (1).  The field's weights are
those of the token's features (the word and its leading 3 to 7 letters), a bias and
the four label transitions.  Forward and backward passes give each token's chance of being
toxic; runs of toxic tokens are the offending spans (character offsets), and the chances are
aggregated to a document score by a logistic map of the largest chance and the expected number
of toxic tokens.

Documents are labelled, not tokens.  Token labels for fitting come from the documents: in a
toxic document, the tokens whose features tell toxic from clean documents best are toxic; the
features that come within ``SLACK`` of a document's best log ratio in several documents form the
cue list, and every token of a toxic document that has a cue is labelled 1, all others 0.

Fitting uses a bounded sample of labelled rows (``fit_docs`` whole texts of each label, by hash
of the id) and at most ``features`` features.  Each gradient is a Spark job over the sample.
Scoring covers every whole text.  The two passes are products of 2 x 2 matrices; they run over
all tokens of a batch at once, cut into blocks, with a reset at each document's first token, so
very long texts cost no more per token than short ones.

Defined cases: null and empty texts and texts without letters score 0 and have no spans;
without labelled rows of both kinds every text scores 0; repeated rows score alike; nulls and
extra columns have no influence.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from clockroll.llm.common import byte_slices, free_name, held, on_workers, sized, staged, unheld

CUTOFF = 0.3
SLACK = 1.5
PREFIXES = (3, 4, 5, 6, 7)
WORDS_KEPT = 400_000
_LETTERS = regex.compile(r"\p{L}+")


def features_of(word: Column) -> Column:
    """Feature names of a lower-case word: the word itself, and its leading letters marked ``+``."""
    lead = [F.when(F.length(word) > n, F.concat(F.substring(word, 1, n), F.lit("+"))) for n in PREFIXES]
    return F.filter(F.array(word, *lead), lambda x: x.isNotNull())


def feature_names(word: str) -> list[str]:
    return [word, *(word[:n] + "+" for n in PREFIXES if len(word) > n)]


# --- the chain ---------------------------------------------------------------------------

def _running(m: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row vectors ``(1, 1) @ m[0] @ ... @ m[t]`` scaled to sum 1, for 2 x 2 matrices given as the
    four arrays of their entries: products within blocks of 16 side by side, the blocks' own
    products by the same function, then both together."""
    n, width = len(m[0]), 16
    if n <= 64:
        out, v0, v1 = np.empty((2, n)), 1.0, 1.0
        for t, (a, b, c, d) in enumerate(zip(*(x.tolist() for x in m), strict=True)):
            v0, v1 = v0 * a + v1 * c, v0 * b + v1 * d
            s = v0 + v1
            v0, v1 = v0 / s, v1 / s
            out[:, t] = v0, v1
        return out[0], out[1]
    blocks = -(-n // width)

    def laid(x: np.ndarray, fill: float) -> np.ndarray:
        return np.concatenate([x, np.full(blocks * width - n, fill)]).reshape(blocks, width).T.copy()

    a, b, c, d = laid(m[0], 1.0), laid(m[1], 0.0), laid(m[2], 0.0), laid(m[3], 1.0)
    for t in range(1, width):
        pa_, pb, pc, pd_ = a[t - 1], b[t - 1], c[t - 1], d[t - 1]
        a[t], b[t], c[t], d[t] = pa_ * a[t] + pb * c[t], pa_ * b[t] + pb * d[t], pc * a[t] + pd_ * c[t], pc * b[t] + pd_ * d[t]
    scale = np.maximum(np.maximum(a[-1], b[-1]), np.maximum(c[-1], d[-1]))
    v0, v1 = _running([x[-1] / scale for x in (a, b, c, d)])
    v0, v1 = np.append(1.0, v0[:-1]), np.append(1.0, v1[:-1])
    out0, out1 = v0 * a + v1 * c, v0 * b + v1 * d
    total = out0 + out1
    return (out0 / total).T.ravel()[:n], (out1 / total).T.ravel()[:n]


def marginals(emission: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Chance of label 1 for each token.  ``emission``: log weight of label 1 against 0; ``first``:
    is the token its document's first; ``trans``: log weights of label pairs."""
    return forward_backward(emission, first, trans, pairs=False)[0]


def forward_backward(emission: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of each label pair over all documents."""
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2))
    x = np.clip(emission, -20, 20)
    e0, e1 = np.exp(np.minimum(-x, 0)), np.exp(np.minimum(x, 0))  # the larger one is 1
    (s00, s01), (s10, s11) = np.exp(np.clip(trans - trans.max(), -20, 0))
    # A document's first token forgets what came before: equal rows.
    reset = lambda w, e: np.where(first, e, w * e)
    f0, f1 = _running([reset(s00, e0), reset(s01, e1), reset(s10, e0), reset(s11, e1)])
    last = np.append(first[1:], True)
    n0, n1 = np.append(e0[1:], 1.0), np.append(e1[1:], 1.0)
    to = lambda w, e: np.where(last, 1.0, w * e)[::-1]
    b0, b1 = (y[::-1] for y in _running([to(s00, n0), to(s10, n0), to(s01, n1), to(s11, n1)]))
    p = f1 * b1 / (f0 * b0 + f1 * b1)
    if not pairs:
        return p, np.zeros((2, 2))
    inside = ~first[1:]
    pair = np.stack([f[:-1] * s * (e[1:] * b[1:]) for f, e, b, s in ((f0, e0, b0, s00), (f0, e1, b1, s01), (f1, e0, b0, s10), (f1, e1, b1, s11))])[:, inside]
    return p, (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)


# --- fitting -----------------------------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, fit_docs: int) -> DataFrame:
    """At most ``fit_docs`` documents of each label; only ids are ordered, and the bounded list of
    chosen ids goes to the texts."""
    of = [labels.where(F.col("toxic") == y).select("id", F.lit(y).alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(fit_docs) for y in (0, 1)]
    chosen = docs.where("text IS NOT NULL").join(F.broadcast(of[0].unionByName(of[1])), "id").dropDuplicates(["id", "toxic"])
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)
    return chosen.select("toxic", words.alias("words")).where(F.size("words") > 0).withColumn("doc", F.monotonically_increasing_id())


def _cues(sample: DataFrame, features: int) -> tuple[list[str], list[str]]:
    """The features that separate the documents best, and those among them that come near the
    best one of a toxic document in at least two documents."""
    named = sample.select("doc", "toxic", F.explode(F.array_distinct(F.flatten(F.transform("words", features_of)))).alias("f"))
    docs = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    rate = (docs.get(0, 0) + 1) / (docs.get(1, 0) + 1)
    table = (named.groupBy("f").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
             .withColumn("weight", F.log((F.col("t") + 0.5) * rate / (F.col("c") + 0.5))).where("t >= 2 AND weight > 2")
             .orderBy(F.desc("weight"), F.length("f").desc(), "f").limit(features))
    rows = table.select("f", "weight").toArrow()  # at most `features` rows; as Arrow, no Python worker makes a table of them
    if not len(rows):
        return [], []
    weight = dict(zip(rows["f"].to_pylist(), rows["weight"].to_pylist(), strict=True))
    best = sample.sparkSession.createDataFrame(rows)
    hits = named.where("toxic = 1").join(F.broadcast(best), "f").withColumn("top", F.max("weight").over(W.partitionBy("doc")))
    won = hits.where(F.col("weight") >= F.col("top") - SLACK).groupBy("f").agg(F.count("*").alias("n")).where("n >= 2").select("f").toPandas()
    return list(weight), sorted(won["f"])


def _coded(sample: DataFrame, names: list[str], cues: list[str]) -> DataFrame:
    """Each document's tokens as feature numbers (-1: none) and token labels."""
    number, cue, width = {f: i for i, f in enumerate(names)}, frozenset(cues), 1 + len(PREFIXES)
    shared = on_workers(sample).sparkSession.sparkContext.broadcast((number, cue))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unheld()
        number, cue = shared.value
        for b in batches:
            feats, golds = [], []
            for toxic, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = [feature_names(w) for w in words]
                feats.append(np.array([[number.get(x, -1) for x in fs] + [-1] * (width - len(fs)) for fs in f], dtype="<i4").tobytes())
                golds.append(np.array([bool(toxic) and not cue.isdisjoint(fs) for fs in f], dtype=np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(feats, pa.binary()), pa.array(golds, pa.binary())], names=["toxic", "feats", "gold"])
    return sample.select("toxic", "words").mapInArrow(run, "toxic int, feats binary, gold binary")


def _arrays(b: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    feats = np.frombuffer(b"".join(b.column("feats").to_pylist()), dtype="<i4").reshape(-1, width)
    golds = b.column("gold").to_pylist()
    first = np.zeros(len(feats), dtype=bool)
    first[np.cumsum([0, *(len(g) for g in golds)])[:-1]] = True
    return feats, np.frombuffer(b"".join(golds), dtype=np.uint8).astype(float), first


def _gradient(coded: DataFrame, weights: np.ndarray, bias: float, trans: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, int]:
    """Gradient of the log likelihood over the sample: one Spark job, one partial sum per task."""
    width, k = 1 + len(PREFIXES), len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unheld()
        total, padded = np.zeros(k + 6), np.append(weights, 0.0)
        for b in batches:
            feats, gold, first = _arrays(b, width)
            p, pairs = forward_backward(padded[feats].sum(axis=1) + bias, first, trans)
            diff = gold - p
            total[:k] += np.bincount(feats.ravel() + 1, np.repeat(diff, width), k + 1)[1:]
            total[k] += diff.sum()
            g, inside = gold.astype(int), ~first[1:]
            seen = np.bincount((2 * g[:-1] + g[1:])[inside], minlength=4).reshape(2, 2)
            total[k + 1:k + 5] += (seen - pairs).ravel()
            total[k + 5] += len(gold)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["g"])
    parts = coded.mapInArrow(run, "g binary").collect()  # one bounded vector per task
    total = np.sum([np.frombuffer(r["g"]) for r in parts], axis=0)
    return total[:k], total[k], total[k + 1:k + 5].reshape(2, 2), int(total[k + 5])


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = 2000, features: int = 20_000, rounds: int = 12) -> dict:
    """The model of the documents ``docs`` (id, text) with ``labels`` (id, toxic)."""
    sample = staged(_sample(docs, labels, fit_docs), "crf-sample")
    names, cues = _cues(sample, features)
    model = {"weights": {}, "bias": -5.0, "trans": np.zeros((2, 2)), "map": (0.0, 0.0, -50.0)}
    if not cues:
        return model
    keep = sorted(set(names))
    coded = staged(_coded(sample, keep, cues), "crf-tokens").coalesce(8)
    # Full-batch ascent by the signs of the gradient: a parameter's step grows while its sign
    # stays and halves when it turns.
    k = len(keep)
    now = np.concatenate([np.zeros(k), [-5.0], np.zeros(4)])
    step, before = np.full(k + 5, 0.5), np.zeros(k + 5)
    for _ in range(rounds):
        gw, gb, gt, _n = _gradient(coded, now[:k], now[k], now[k + 1:].reshape(2, 2))
        g = np.concatenate([gw, [gb], gt.ravel()]) - 0.05 * now
        turn = np.sign(g) * np.sign(before)
        step = np.clip(np.where(turn > 0, step * 1.3, np.where(turn < 0, step * 0.5, step)), 1e-3, 2.0)
        before = np.where(turn < 0, 0.0, g)
        now = now + np.sign(before) * step
    w, bias, trans = now[:k], float(now[k]), now[k + 1:].reshape(2, 2)
    model |= {"weights": dict(zip(keep, w.tolist(), strict=True)), "bias": bias, "trans": trans}
    model["map"] = _score_map(sample, model)
    return model


def _score_map(sample: DataFrame, model: dict) -> tuple[float, float, float]:
    """Logistic regression of the sample's labels on the two aggregates (Newton steps)."""
    src = sample.select(F.monotonically_increasing_id().alias("doc_id"), F.concat_ws(" ", "words").alias("text"), "toxic")
    got = _tagged(src, model, ("toxic",)).select("toxic", "top", "expected").toPandas()  # the bounded sample
    x = np.stack([_logit(got["top"].to_numpy()), np.log1p(got["expected"].to_numpy()), np.ones(len(got))], axis=1)
    y, b = got["toxic"].to_numpy(dtype=float), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(3)
        b = b + np.linalg.solve(h, x.T @ (y - p) - 0.5 * b)
    return tuple(b.tolist())


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


# --- scoring -----------------------------------------------------------------------------

class _Emissions(dict):
    def __init__(self, model: dict):
        super().__init__()
        self.weights, self.bias = model["weights"], model["bias"]

    def __missing__(self, word: str) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        got = self[word] = self.bias + sum(self.weights.get(f, 0.0) for f in feature_names(word))
        return got


def _tag_batches(shared, passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, emissions = shared.value, held(shared, _Emissions)
        for b in byte_slices(batches, passes):
            texts = [t or "" for t in b.column(passes).to_pylist()]
            lows = [t.lower() for t in texts]
            words = [_LETTERS.findall(t) for t in lows]
            counts = np.array([len(w) for w in words])
            e = np.fromiter((emissions[w] for ws in words for w in ws), float, int(counts.sum()))
            ends = np.cumsum(counts)
            first = np.zeros(len(e), dtype=bool)
            first[(ends - counts)[counts > 0]] = True
            p = marginals(e, first, model["trans"])
            out: dict[str, list] = {"top": [], "expected": [], "n_words": [], "spans": []}
            for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist(), strict=True)):
                q = p[end - n:end]
                out["top"].append(float(q.max()) if n else 0.0)
                out["expected"].append(float(q[q > 0.01].sum()) if n else 0.0)
                out["n_words"].append(n)
                out["spans"].append(_spans(texts[i], lows[i], q) if n and q.max() >= 0.5 else [])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(passes)), pa.array(out["n_words"], pa.int64()), pa.array(out["top"], pa.float64()), pa.array(out["expected"], pa.float64()), pa.array(out["spans"], kind)],
                names=[*b.schema.names[:passes], "n_words", "top", "expected", "spans"])
        emissions.clear()  # most words of a task are its own
    return run


def _spans(text: str, low: str, q: np.ndarray) -> list[dict]:
    """Runs of tokens with a chance of at least one half, as character offsets in the text.
    (Lower-casing that changes a text's length falls back to offsets in the lower-cased text.)"""
    out: list[dict] = []
    at = np.flatnonzero(q >= 0.5)
    want, before = set(at.tolist()), -2
    for k, m in enumerate(_LETTERS.finditer(low)):
        if k in want:
            if before == k - 1:
                out[-1]["end"], out[-1]["score"] = m.end(), max(out[-1]["score"], float(q[k]))
            else:
                out.append({"start": m.start(), "end": m.end(), "score": float(q[k])})
            before = k
    return out


def _tagged(df: DataFrame, model: dict, keep: tuple[str, ...], text_col: str = "text") -> DataFrame:
    shared = on_workers(df).sparkSession.sparkContext.broadcast(model)
    src = df.select(*[df[f"`{c}`"] for c in keep], df[f"`{text_col}`"].alias(free_name(keep, "text")))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    found = [T.StructField("n_words", T.LongType()), T.StructField("top", T.DoubleType()), T.StructField("expected", T.DoubleType()), T.StructField("spans", spans)]
    return src.mapInArrow(_tag_batches(shared, len(keep)), T.StructType([*src.schema.fields[:len(keep)], *found]))


def unoffending(df: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text scores below ``CUTOFF``.  A verdict is a function of the
    text, so only the texts pass through Python; what comes back are the digests of the toxic ones,
    and rows go by a join on them."""
    digest = lambda text: F.struct(F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2"))
    texts = df.select(digest(df[f"`{text_col}`"]).alias("digest"), df[f"`{text_col}`"].alias("text"))
    toxic = score(texts, model, keep=("digest",)).where("predicted = 1").select("digest.h1", "digest.h2").distinct()
    rows = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"), digest(df[f"`{text_col}`"]).alias("_digest"))
    gone = sized(staged(toxic, "crf-toxic"))
    return rows.join(gone, (F.col("_digest.h1") == gone["h1"]) & (F.col("_digest.h2") == gone["h2"]), "left_anti").select("_row.*")


def score(df: DataFrame, model: dict, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1), ``predicted`` and the offending ``spans`` of every text.  Put
    whole rows in one struct column to keep columns whose names clash with these."""
    a, b, c = model["map"]
    top = F.least(F.greatest(F.col("top"), F.lit(1e-6)), F.lit(1 - 1e-6))
    z = F.lit(a) * F.log(top / (1 - top)) + F.lit(b) * F.log1p("expected") + F.lit(c)
    chance = F.when(F.col("n_words") == 0, F.lit(0.0)).otherwise(1 / (1 + F.exp(-z)))
    return (_tagged(df, model, keep, text_col).withColumn("score", chance)
            .withColumn("predicted", (F.col("score") >= CUTOFF).cast("int")).select(*[f"`{c}`" for c in keep], "score", "predicted", "spans"))
