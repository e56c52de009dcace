"""Operator 12: hard negatives found with an STR-packed R-tree.

Components become whole numbers (``floor(scale * x)``); a row's score for an anchor is their inner product.

Tree.  Rows are dealt by ranges of (label, first component, hash of the id) into parts of about
``PART_ROWS`` rows, so neither a large label nor a much repeated vector makes a large part.  In
a part the rows of each label are packed by sort-tile-recursion: sorted by one coordinate, cut into
slabs, each slab by the next one, the most spread coordinates first, down to leaves of ``LEAF`` rows;
``FAN`` neighbours make a node of the next level.  The tree is a table in the shared folder: the
leaves of each part, and a directory with one box per part and label (about 1 KB per part).

Search.  A box bounds the inner product with an anchor by an interval: per coordinate the smaller and the
larger of its two products.  A queue visits boxes by falling upper bound.  A box is left out
if its interval misses the score window, if its bound lies strictly below the k-th score found, or
if it ties with that score and holds no smaller id.  Positives are searched in the trees
of the anchor's label with an open window, then negatives in all others with the windows of its
positives; a row is scored once for all windows of its anchor.

Anchors are dealt into blocks of about ``BLOCK`` rows, one task each.  A task reads the directory and opens the
parts its anchors still need, best bound first, so it returns final rows only, and memory is one
block, the directory and ``OPEN_PARTS`` parts.

Sums are exact: in double precision while they stay below 2^53, else in whole numbers without a
bound (a score that does not fit a long is an error).

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part;
of vectors of several lengths the shorter count as filled up with zeros; rows equal in id, label
and vector count once; a row with an anchor's id is neither its positive nor its negative;
anchors with equal ids are searched apart and told apart by nothing; ties go to the smaller id; an anchor
without positives or without negatives in a window gives no rows; an empty table gives
none.  Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, functions as F

from clockroll.llm.common import on_workers, shared_files, staged
from clockroll.session import scratch_dir

PART_ROWS, LEAF, FAN = 32_768, 64, 16
BLOCK, OPEN_PARTS = 256, 4
EXACT = 1 << 53
TREE = "kind string, part int, label long, leaf int, ids binary, vecs binary, low binary, high binary, least long"
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """``id``, ``label``, ``vec`` (array<double>) of the rows that take part."""
    v = F.transform(df[f"`{vec_col}`"], lambda x: x.cast("double"))
    rows = df.select(df[f"`{id_col}`"].cast("long").alias("id"), df[f"`{label_col}`"].cast("long").alias("label"), v.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where("id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL").where(finite)


# --- packing -----------------------------------------------------------------------------

def _matrix(lists: list, width: int, scale: float) -> np.ndarray:
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, :len(v)] = v
    return np.floor(scale * out)


def _counted(x: np.ndarray, exact: bool) -> np.ndarray:
    """Whole numbers as doubles where sums of products are exact in them, else as Python's integers."""
    return x if exact or not x.size else np.frompyfunc(int, 1, 1)(x)


def str_order(x: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Rows of ``x`` in leaves, by sort-tile-recursion over the coordinates, the most spread ones first."""
    coords = np.argsort(-x.std(axis=0), kind="stable").tolist()

    def cut(at: np.ndarray, depth: int) -> list[np.ndarray]:
        pages = -(-len(at) // leaf)
        if pages <= 1:
            return [at]
        if depth >= len(coords):  # no coordinate is left: rows in the order they have
            return [at[lo:lo + leaf] for lo in range(0, len(at), leaf)]
        slabs = max(2, int(np.ceil(pages ** (1 / (len(coords) - depth)))))
        size = -(-pages // slabs) * leaf
        at = at[np.argsort(x[at, coords[depth]], kind="stable")]
        return [p for lo in range(0, len(at), size) for p in cut(at[lo:lo + size], depth + 1)]
    return cut(np.arange(len(x)), 0)


def _packer(width: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids, labels, mats = [], [], []
        for b in batches:  # one part: a bounded number of rows
            ids.append(np.asarray(b.column(0)))
            labels.append(np.asarray(b.column(1)))
            mats.append(_matrix(b.column(2).to_pylist(), width, scale))
        if not ids:
            return
        i, lab, x = np.concatenate(ids), np.concatenate(labels), np.concatenate(mats)
        schema = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("label", pa.int64()), ("leaf", pa.int32()), ("ids", pa.binary()), ("vecs", pa.binary()), ("low", pa.binary()), ("high", pa.binary()), ("least", pa.int64())])
        for label in np.unique(lab).tolist():
            own = np.flatnonzero(lab == label)
            own = own[np.argsort(i[own], kind="stable")]
            own = own[_first_of_equal(i[own], x[own])]
            rows = []
            for n, at in enumerate(str_order(x[own])):
                at = own[at]
                rows.append({"kind": "leaf", "part": part, "label": label, "leaf": n, "ids": i[at].astype("<i8").tobytes(), "vecs": x[at].tobytes(),
                             "low": x[at].min(axis=0).tobytes(), "high": x[at].max(axis=0).tobytes(), "least": int(i[at].min())})
            rows.append({"kind": "box", "part": part, "label": label, "leaf": -1, "ids": None, "vecs": None,
                         "low": x[own].min(axis=0).tobytes(), "high": x[own].max(axis=0).tobytes(), "least": int(i[own].min())})
            yield pa.RecordBatch.from_pylist(rows, schema)
    return run


def _first_of_equal(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of rows sorted by id, those not equal to an earlier row of the same id."""
    seen, keep = set(), np.ones(len(ids), dtype=bool)
    again = np.flatnonzero(np.append(False, ids[1:] == ids[:-1]) | np.append(ids[1:] == ids[:-1], False))
    for k in again.tolist():
        key = (int(ids[k]), x[k].tobytes())
        keep[k] = key not in seen
        seen.add(key)
    return keep


# --- search ------------------------------------------------------------------------------

class Tree:
    """The boxes and rows of one part and label."""

    def __init__(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, ids: list[np.ndarray], vecs: list[np.ndarray]):
        self.ids, self.vecs, leaves = ids, vecs, len(ids)
        lows, highs, leasts, first, begin = [low], [high], [least], [], 0
        self.children: dict[int, range] = {}
        while len(lows[-1]) > 1:
            cut = np.arange(0, len(lows[-1]), FAN)
            upto = np.append(cut[1:], len(lows[-1]))
            first.append(begin)
            begin += len(lows[-1])
            for k, (a, b) in enumerate(zip(cut.tolist(), upto.tolist(), strict=True)):
                self.children[begin + k] = range(first[-1] + a, first[-1] + b)
            lows.append(np.minimum.reduceat(lows[-1], cut, axis=0))
            highs.append(np.maximum.reduceat(highs[-1], cut, axis=0))
            leasts.append(np.minimum.reduceat(leasts[-1], cut))
        self.low, self.high, self.least = np.concatenate(lows), np.concatenate(highs), np.concatenate(leasts).tolist()
        self.root, self.leaves = len(self.low) - 1, leaves


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner products of the rows of ``q`` with anything in each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


class Window:
    """The best ``k`` rows with scores in [low, high]: largest first, smaller ids first among equals."""

    def __init__(self, k: int, low=-np.inf, high=np.inf):
        self.k, self.low, self.high, self.best = k, low, high, []

    def wants(self, least, most, smallest_id: int) -> bool:
        if most < self.low or least > self.high:
            return False
        if len(self.best) < self.k:
            return True
        score, worst = -self.best[-1][0], self.best[-1][1]
        bound = min(most, self.high)
        return bound > score or (bound == score and smallest_id < worst)

    def add(self, ids: np.ndarray, scores: np.ndarray, own: int) -> None:
        ok = (scores >= self.low) & (scores <= self.high) & (ids != own)
        if len(self.best) == self.k:
            ok &= scores >= -self.best[-1][0]
        if ok.any():
            at = np.flatnonzero(ok)
            at = at[np.lexsort((ids[at], -scores[at]))[:self.k]]
            self.best = sorted(self.best + [(-scores[j], int(ids[j])) for j in at.tolist()])[:self.k]


def descend(tree: Tree, q: np.ndarray, own: int, least: np.ndarray, most: np.ndarray, windows: list[Window]) -> None:
    """Best-first through one tree for each window; ``least``, ``most``: the intervals of its nodes."""
    scores: dict[int, np.ndarray] = {}
    for w in windows:
        queue = [(-most[tree.root], tree.root)]
        while queue:
            bound, node = heapq.heappop(queue)
            if len(w.best) == w.k and min(-bound, w.high) < -w.best[-1][0]:
                break  # all others are bounded by less
            if not w.wants(least[node], most[node], tree.least[node]):
                continue
            if node < tree.leaves:
                if node not in scores:
                    scores[node] = tree.vecs[node] @ q
                w.add(tree.ids[node], scores[node], own)
            else:
                for c in tree.children[node]:
                    if w.wants(least[c], most[c], tree.least[c]):
                        heapq.heappush(queue, (-most[c], c))


class Forest:
    """The tree table as a task reads it."""

    def __init__(self, path: str, width: int, exact: bool):
        self.fs, self.path = shared_files(path)
        self.width, self.exact = width, exact
        box = self._table("kind=box")
        self.part, self.label, self.least = (box[c].to_numpy() for c in ("part", "label", "least"))
        self.low, self.high = (self._boxes(box[c]) for c in ("low", "high"))
        self.open: OrderedDict[int, dict[int, Tree]] = OrderedDict()

    def _table(self, folder: str) -> pa.Table:
        from pyarrow import fs

        found = [f.path for f in self.fs.get_file_info(fs.FileSelector(f"{self.path}/{folder}", recursive=True)) if f.is_file and f.base_name.startswith("part-")]
        tables = []
        for f in found:
            t = pq.ParquetFile(f, filesystem=self.fs).read()
            part = next((int(x[5:]) for x in f.split("/") if x.startswith("part=")), None)
            tables.append(t if part is None else t.append_column("part", pa.array(np.full(len(t), part, np.int32))))
        return pa.concat_tables(tables)

    def _boxes(self, col) -> np.ndarray:
        return _counted(np.frombuffer(b"".join(col.to_pylist())).reshape(len(col), self.width), self.exact)

    def trees(self, part: int) -> dict[int, Tree]:
        """The trees of a part by label; the parts used last stay open."""
        if part not in self.open:
            t = self._table(f"kind=leaf/part={part}").sort_by([("label", "ascending"), ("leaf", "ascending")])
            labels, out = t["label"].to_numpy(), {}
            for label in np.unique(labels).tolist():
                at = np.flatnonzero(labels == label)
                own = t.slice(int(at[0]), len(at))
                ids = [np.frombuffer(x, "<i8") for x in own["ids"].to_pylist()]
                vecs = [_counted(np.frombuffer(x).reshape(len(i), self.width), self.exact) for x, i in zip(own["vecs"].to_pylist(), ids, strict=True)]
                out[label] = Tree(self._boxes(own["low"]), self._boxes(own["high"]), own["least"].to_numpy(), ids, vecs)
            self.open[part] = out
            while len(self.open) > OPEN_PARTS:
                self.open.popitem(last=False)
        self.open.move_to_end(part)
        return self.open[part]

    def search(self, q: np.ndarray, ids: list[int], allowed: np.ndarray, windows: list[list[Window]]) -> None:
        """Fill the ``windows`` of each anchor from the boxes it is ``allowed`` (anchors x boxes)."""
        least, most = intervals(q, self.low, self.high)
        reach = np.where(allowed, most, -np.inf)
        for k in np.argsort(-reach.max(axis=0).astype(float), kind="stable").tolist():
            asking = [i for i in np.flatnonzero(allowed[:, k]).tolist() if any(w.wants(least[i, k], most[i, k], int(self.least[k])) for w in windows[i])]
            if asking:
                tree = self.trees(int(self.part[k]))[int(self.label[k])]
                lo, hi = intervals(q[asking], tree.low, tree.high)
                for j, i in enumerate(asking):
                    descend(tree, q[i], ids[i], lo[j].tolist(), hi[j].tolist(), windows[i])


def _miner(path: str, width: int, scale: float, exact: bool, positives: int, negatives: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = None
        schema = pa.schema([(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in FOUND.split(", ")])
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                b = whole.slice(lo, BLOCK)
                forest = forest or Forest(path, width, exact)
                ids, labels = b.column(0).to_pylist(), np.asarray(b.column(1))
                q = _counted(_matrix(b.column(2).to_pylist(), width, scale), exact)
                same = labels[:, None] == forest.label[None, :]
                liked = [[Window(positives)] for _ in ids]
                forest.search(q, ids, same, liked)
                # 100 * negative between percent * positive and 100 * positive
                scores = [sorted({-s for s, _ in w[0].best}, reverse=True) for w in liked]
                tops = [[Window(negatives, s * percent / 100 if exact else _ceil(s * percent, 100), s) for s in ss] for ss in scores]
                forest.search(q, ids, ~same, tops)
                rows = []
                for i, anchor in enumerate(ids):
                    by_score = dict(zip(scores[i], tops[i], strict=True))
                    for s, p in liked[i][0].best:
                        for rank, (n, other) in enumerate(by_score[-s].best, 1):
                            rows.append((anchor, p, rank, other, int(-s), int(-n)))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)
    return run


def _ceil(a, b):
    return -((-a) // b)


def build(rows: DataFrame, width: int, scale: float) -> str:
    """Write the tree of ``rows`` (id, label, vec) to the shared folder; returns its path."""
    on_workers(rows)
    path = scratch_dir(rows.sparkSession, "rtree") + "/tree"
    parts = max(1, -(-rows.count() // PART_ROWS))
    order = ["label", F.coalesce(F.get("vec", F.lit(0)), F.lit(0.0)), F.xxhash64("id")]
    dealt = rows.repartitionByRange(parts, *order)
    dealt.mapInArrow(_packer(width, scale), TREE).write.partitionBy("kind", "part").parquet(path)
    return path


def mine(df: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, percent: int = 80, scale: float = 256.0) -> DataFrame:
    """Hard negatives (``FOUND``) of the rows of ``df`` (id, label, vec; see ``usable``) for which ``anchors`` holds.  For
    each anchor and each of its best ``positives`` rows of its label: the best ``negatives`` rows of other labels with
    percent * positive score <= 100 * score <= 100 * positive score."""
    spark = on_workers(df).sparkSession
    rows = staged(df.select("id", "label", "vec"), "rtree-rows")
    largest = F.max(F.coalesce(F.array_max(F.transform("vec", lambda x: F.abs(x))), F.lit(0.0)))
    facts = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width"), largest.alias("most")).first()
    if not facts["n"]:
        return spark.createDataFrame([], FOUND)
    width, most = facts["width"], scale * facts["most"] + 1
    exact = width * most * most * 128 < EXACT
    path = build(rows, width, scale)
    asked = rows.where(anchors).distinct()
    blocks = max(1, -(-asked.count() // BLOCK))
    return asked.repartition(blocks, "id").mapInArrow(_miner(path, width, scale, exact, positives, negatives, percent), FOUND)


#: Anchors, their first positives, and the first negatives of each window, all by comparing whole rows.
SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS lab,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.lab = b.lab AS same, CAST(list_inner_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
