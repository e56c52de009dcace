"""Operator 10: nearest neighbours by balanced posting lists.

Index.  Centroids are fitted on a bounded sample (``FIT_ROWS`` vectors, by hash of the id) by
balanced k-means: a centroid's cost rises with its list's length, and groups that still exceed
twice the mean are split.  The number of centroids grows with the fourth root of the rows, up to
``MAX_LISTS`` (a query probes a share of them, so its partial results grow as slowly); long lists
are cut into blocks of ``BLOCK_ROWS`` rows, so a list may hold any share of the table.  Every row goes to its nearest list, and a row near a border is replicated to
further lists, up to ``REPLICAS``, whose centroids lie within ``BORDER`` times its nearest distance
and are not closer to a centroid already taken than to the row.

Search.  A query walks an in-memory neighbour graph of the centroids (best first, from a few
entry points) to a bounded number of nearest centroids, and distance-ratio pruning keeps the lists
within ``RATIO`` times the distance of the ``LEAST_LISTS``-th nearest one (a list of few rows may
lie at a distance of almost 0, so the nearest alone is no measure).  Query-list pairs meet the blocks of their list;
each block returns its best ``k`` per query, and the best ``k`` of those win.

Nearness is the inner product.  For lists, vectors are mapped to a space in which the largest
inner product is the smallest distance: one more coordinate, sqrt(M^2 - |v|^2) with M the
largest norm, 0 for queries.  Scores are computed in double precision on the vectors as given.

Defined cases: vectors that are null, zero, or hold null or non-finite components, and vectors
of another length than the most frequent one, take no part; rows with equal ids and vectors
count once; with no more than ``k`` candidates all are returned; ties go to the smaller id; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clockroll.llm.common import on_workers, staged

FIT_ROWS = 20_000
LISTS_FACTOR = 16
MAX_LISTS = 4096
BLOCK_ROWS = 4096
REPLICAS = 4
BORDER = 1.15
PROBES_SHARE, PROBES_LEAST = 0.6, 32
RATIO = 1.25
LEAST_LISTS = 8
GRAPH_DEGREE = 24


def usable(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vec`` (array<double>) of the rows that take part."""
    v = F.transform(df[f"`{vec_col}`"], lambda x: x.cast("double"))
    rows = df.select(df[f"`{id_col}`"].cast("long").alias("vec_id"), v.alias("vec")).where("vec_id IS NOT NULL AND vec IS NOT NULL")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(finite & F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))
    top = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(1).select("dim")
    return rows.join(F.broadcast(top), "dim").drop("dim").distinct()


def fit_centroids(sample: np.ndarray, n_lists: int, rounds: int = 12) -> np.ndarray:
    """Balanced k-means of a bounded sample."""
    rng = np.random.default_rng(11)
    n_lists = min(n_lists, -(-len(sample) // 4))
    cent = sample[rng.choice(len(sample), n_lists, replace=False)]
    mean, load = len(sample) / n_lists, np.full(n_lists, len(sample) / n_lists)
    spread = float(np.median(((sample[:512, None] - cent[None, :64]) ** 2).sum(-1)))
    for _ in range(rounds):
        # A list longer than the mean costs its members more.
        own = _nearest(sample, cent, 0.2 * spread * (load / mean - 1))
        load = 0.5 * load + 0.5 * np.bincount(own, minlength=n_lists)
        for k in range(n_lists):
            got = sample[own == k]
            cent[k] = got.mean(axis=0) if len(got) else sample[rng.integers(len(sample))]
    own = _nearest(sample, cent, np.zeros(n_lists))
    extra = []
    for k in np.flatnonzero(np.bincount(own, minlength=n_lists) > 2 * mean):
        got = sample[own == k]
        axis = got - got.mean(axis=0)
        side = axis @ axis[np.argmax((axis ** 2).sum(axis=1))] > 0
        if side.any() and not side.all():
            cent[k] = got[side].mean(axis=0)
            extra.append(got[~side].mean(axis=0))
    return np.concatenate([cent, np.array(extra)]) if extra else cent


def _nearest(x: np.ndarray, c: np.ndarray, extra: np.ndarray) -> np.ndarray:
    return np.concatenate([(_squares(x[lo:lo + 1024], c) + extra).argmin(axis=1) for lo in range(0, len(x), 1024)])


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)


class CentroidGraph:
    """Neighbour graph of the centroids, searched best first."""

    def __init__(self, cent: np.ndarray):
        self.cent = cent
        near = np.argsort(_squares(cent, cent), axis=1)[:, 1:GRAPH_DEGREE + 1]
        links = [set(r.tolist()) for r in near]
        for a, r in enumerate(near.tolist()):
            for b in r:
                links[b].add(a)
        self.links = [np.array(sorted(x), dtype=np.int64) for x in links]
        self.entries = np.unique(np.linspace(0, len(cent) - 1, min(len(cent), 16)).astype(int))

    def nearest(self, q: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """About the ``n`` nearest centroids and their squared distances, nearest first."""
        seen = np.zeros(len(self.cent), dtype=bool)
        seen[self.entries] = True
        d = ((self.cent[self.entries] - q) ** 2).sum(axis=1)
        todo = list(zip(d.tolist(), self.entries.tolist(), strict=True))
        best = [(-a, b) for a, b in todo]
        heapq.heapify(todo)
        heapq.heapify(best)
        while len(best) > n:
            heapq.heappop(best)
        while todo:
            at, k = heapq.heappop(todo)
            if len(best) >= n and at > -best[0][0]:
                break
            new = self.links[k][~seen[self.links[k]]]
            seen[new] = True
            for a, b in zip(((self.cent[new] - q) ** 2).sum(axis=1).tolist(), new.tolist(), strict=True):
                if len(best) < n:
                    heapq.heappush(best, (-a, b))
                elif a < -best[0][0]:
                    heapq.heapreplace(best, (-a, b))
                else:
                    continue
                heapq.heappush(todo, (a, b))
        out = sorted((-a, b) for a, b in best)
        return np.array([b for _, b in out], dtype=np.int64), np.array([a for a, _ in out])


_built: list = []


def _index_of(shared) -> tuple[CentroidGraph, float]:
    if not _built or _built[0] is not shared:
        cent, norm = shared.value
        _built[:] = [shared, CentroidGraph(cent), norm]
    return _built[1], _built[2]


def _vectors(col: pa.ListArray) -> np.ndarray:
    return np.asarray(col.flatten()).reshape(len(col), -1)


def _posted(shared):
    """Each row's lists: the nearest one, and further ones for rows near a border."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, norm = _index_of(shared)
        cent = graph.cent
        apart = _squares(cent, cent)
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                x = _lifted(_vectors(b.column(1)), norm)
                d = _squares(x, cent)
                few = np.argsort(d, axis=1)[:, :2 * REPLICAS]
                rows, lists = [], []
                for i, order in enumerate(few.tolist()):
                    taken: list[int] = []
                    for k in order:
                        if d[i, k] > BORDER ** 2 * d[i, order[0]] or len(taken) >= REPLICAS:
                            break
                        if all(apart[k, t] > d[i, k] for t in taken):
                            taken.append(k)
                    rows += [i] * len(taken)
                    lists += taken
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), b.column(1).take(pa.array(rows)), pa.array(lists, pa.int32())], names=["vec_id", "vec", "list"])
    return run


def _routed(shared, probes: int):
    """Each query's lists, by the graph and the distance ratio."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, norm = _index_of(shared)
        for b in batches:
            rows, lists = [], []
            x = _vectors(b.column(1))
            for i in range(len(x)):
                q = np.append(x[i] * (norm / max(np.linalg.norm(x[i]), 1e-300)), 0.0)
                near, d = graph.nearest(q, probes)
                near = near[d <= RATIO ** 2 * d[min(LEAST_LISTS, len(d)) - 1]]
                rows += [i] * len(near)
                lists += near.tolist()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), b.column(1).take(pa.array(rows, pa.int64())), pa.array(lists, pa.int32())], names=["query_id", "q", "list"])
    return run


def _lifted(x: np.ndarray, norm: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(norm ** 2 - (x * x).sum(axis=1), 0))[:, None]], axis=1)


def _best_in_block(k: int):
    """The best ``k`` rows of a block for each query, and those that tie with them within rounding."""
    def run(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        got: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            rows = rows.sort_values("vec_id")
            ids, x = rows["vec_id"].to_numpy(), np.stack(rows["vec"].to_numpy())
            for lo in range(0, len(queries), 256):
                part = queries.iloc[lo:lo + 256]
                asked = np.stack(part["q"].to_numpy())
                for q, v, s in zip(part["query_id"].to_numpy(), asked, asked @ x.T, strict=True):
                    s[ids == q] = -np.inf
                    n = min(k, len(s))
                    at = np.flatnonzero(s >= np.partition(s, len(s) - n)[len(s) - n] - 1e-9)
                    exact = (x[at] * v).sum(axis=1)  # equal for equal rows, wherever they stand
                    best = np.lexsort((ids[at], -exact))[:k]
                    best = best[ids[at[best]] != q]
                    got["query_id"].append(np.full(len(best), q))
                    got["vec_id"].append(ids[at[best]])
                    got["score"].append(exact[best])
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0, t) for (c, v), t in zip(got.items(), (np.int64, np.int64, float), strict=True)})
    return run


def search(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of each row for which ``queries`` (over ``vec_id``) holds: ``query_id``, ``rank``,
    ``vec_id``, ``score``."""
    spark = on_workers(df).sparkSession
    rows = staged(usable(df, id_col, vec_col), "ann-rows")
    norm2 = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(F.count("*").alias("n"), F.sqrt(F.max(norm2)).alias("norm")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not facts["n"]:
        return empty
    sample = np.array([r["vec"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).collect()])  # bounded
    cent = fit_centroids(_lifted(sample, facts["norm"]), min(MAX_LISTS, int(LISTS_FACTOR * facts["n"] ** 0.25)))
    shared = spark.sparkContext.broadcast((cent, float(facts["norm"])))
    probes = max(PROBES_LEAST, int(PROBES_SHARE * len(cent)))
    posted = staged(rows.mapInArrow(_posted(shared), "vec_id long, vec array<double>, list int"), "ann-lists")
    # Long lists are cut into blocks, so none grows with the table.
    blocks = posted.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocks = staged(blocks, "ann-blocks")
    lists = posted.join(F.broadcast(blocks), "list").select("list", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "vec")
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("vec").alias("q"))
    routed = asked.mapInArrow(_routed(shared, probes), "query_id long, q array<double>, list int")
    of = blocks.select(F.col("list").alias("at"), F.col("blocks").alias("of"))
    routed = routed.join(F.broadcast(of), routed["list"] == of["at"]).select("query_id", "q", "list", F.explode(F.sequence(F.lit(0), F.col("of") - 1)).alias("block"))
    found = (routed.groupBy("list", "block").cogroup(lists.groupBy("list", "block"))
             .applyInPandas(_best_in_block(k), "query_id long, vec_id long, score double"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # Replicas of a row come side by side: a dense rank counts them once.
    ranked = found.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return ranked.distinct().select("query_id", "rank", "vec_id", "score")
