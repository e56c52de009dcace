"""Operator 9: exact Jaccard join of word-shingle sets in the metric space of Jaccard distances.

Distance is 1 - |x & y| / |x | y|, a metric; documents link at distance ``EPS`` = 0.25 or less.

Level 0, pivots that are points of the space but no documents: the one-shingle sets, in a fixed
order.  A set x is nearer to {s} than to any set it shares nothing with exactly if s is in x,
so the Voronoi region of {s} can only hold sets with s; of several pivots at the same distance
the first in the order is home.  Boundary sets are replicated by the triangle inequality: a
set y within EPS of x lacks at most EPS * |x| of x's shingles, so the first pivot the two
share is among x's first ``|x| - ceil(0.75 |x|) + 1``; x goes to these regions and to no other.
Any order of the shingles gives exact results.  Shingles with hashes in ``COUNTED``, a fixed part of the
hash space that holds more shingles of a set than it has regions, come first, by the exact number of rows
they occur in; then the others by hash; shingles that are frequent in a bounded sample come last.  A shingle
of one class only is a region without pairs, so a set with enough of them is in no region at all:
documents that merely share passages leave here, however rare the passages are.  Regions with the same members hold the same pairs and are joined
once.

Level 1, pivots that are documents: each region elects its smallest set id, and the distance
of every member to it is bounded or computed.  Members within EPS link.  A region whose members
then belong to one component is finished; this is the normal end of a group of copies, at a
cost linear in its size.  A wide region of several components elects further pivots from its largest
component and compares the members outside with them, as long as that component grows: each turn is
linear in the region's size.  In what is left two members can only link if their distances to the
pivot differ by EPS at most (triangle inequality); pairs of different components inside that
window are compared, each in the first region that both members list as their own.  (``join_links`` needs every link: there no region is finished early, and all
pairs inside the window are compared.)

Recursion: a region with too many such pairs is not expanded.  The shingles of such regions go to
the end of the order, their members are dealt anew into regions in that order and joined by the
same steps.  If that leaves more than half of the pairs, dealing does not part these members; then, and after
``LEVELS`` levels, the windows are expanded whatever their size.

Documents with equal sets form one class and are compared once.  Comparisons first bound the
symmetric difference from below by the Hamming distance of parity sketches, narrow ones where the
pairs are made and wide ones for the pairs left, then intersect the
sets; only the sets of pairs that the bound leaves open are made again from their texts.
Shingles and classes are identified by 64-bit hashes.

Defined cases: null texts and texts without words have 0 shingles and link with nothing, equal
ones included; fewer than five words are one shingle; rows with a null id are joined like
others, their component is the smallest id that is not null, and null if there is none;
repeated rows link with each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from clockroll.llm.common import byte_slices, freed, gathered, on_workers, sized, spare, staged, unheld

WORDS = 5
EPS = 0.25
SAMPLE_DOCS = 16_384
FREQUENT = 1 << 17
FREQUENT_FROM = 3
WIDE = 8
#: A class lists so many of its regions; pairs that meet in more regions than listed are made distinct later.
LISTED = 64
#: Further pivots that a wide region elects in a turn, and turns at most (what is left is dealt anew or expanded).
PIVOTS, TURNS = 4, 3
LEVELS = 3
SKETCH_BITS = 2048
#: Shingles with hashes below this (3/8 of all) are counted exactly before the regions are made.
COUNTED = np.uint64(3 << 61)
COARSE = tuple(f"q{i}" for i in range(16))  # the sketch folded to 64 bits each
PIECE = 4 << 20
#: Bytes of text hashed at a time; the arrays of a slice have several 64-bit numbers for each byte.
SLICE = 1 << 18

_rng = np.random.Generator(np.random.PCG64(5_2024))
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _STEP = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: dict[str, np.ndarray] = {}


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            p = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def _word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word and where it begins, from running sums over the bytes."""
    data = np.frombuffer(text + b" ", dtype=np.uint8)
    up, down = _power_table(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:len(data)])))
    gap = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    return _mixed((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64)), begin


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut after ``PIECE`` bytes or at the first white space beyond."""
    lo = 0
    while lo < len(text):
        gap = _GAP.search(text, lo + PIECE)
        hi = gap.start() if gap else len(text)
        yield text[lo:hi]
        lo = hi


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.  The words of short texts are hashed all at
    once, those of a long one piece by piece."""
    raw = [(t or "").encode().translate(_LOWER) for t in texts]
    if len(raw) == 1 and len(raw[0]) > PIECE:
        words = np.concatenate([_word_hashes(p)[0] for p in _pieces(raw[0])])
        bounds = np.array([0, len(words)])
    else:
        words, begin = _word_hashes(b" ".join(raw))
        bounds = np.searchsorted(begin, np.cumsum([0, *(len(r) + 1 for r in raw)]))
    n = max(0, len(words) - WORDS + 1)
    run = np.zeros(n, np.uint64)
    for k in range(WORDS):
        run = run * _STEP + words[k:k + n]
    run = _mixed(run)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= WORDS:
            s = np.sort(run[lo:hi - WORDS + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif hi > lo:
            h = np.uint64(hi - lo)
            with np.errstate(over="ignore"):
                for w in words[lo:hi]:
                    h = h * _STEP + w
            out.append(_mixed(np.array([h], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sketch(s: np.ndarray) -> bytes:
    """One parity bit for each of ``SKETCH_BITS`` hash classes."""
    odd = np.bincount((s >> np.uint64(20)).astype(np.int64) & (SKETCH_BITS - 1), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _folded(sketches: list[bytes]) -> list[np.ndarray]:
    """``COARSE`` of each sketch: bits that are equal modulo their number go into one parity."""
    x = np.frombuffer(b"".join(sketches), np.int64).reshape(len(sketches), -1, len(COARSE))
    return list(np.bitwise_xor.reduce(x, axis=1).T)


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unheld()
    for b in byte_slices(batches, 2, SLICE):
        sets = shingle_sets(b.column(2).to_pylist())
        cls = [_class_id(s) if len(s) else None for s in sets]
        sketches = [_sketch(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(cls, pa.int64()), pa.array(sketches, pa.binary()), *map(pa.array, _folded(sketches))],
            names=["doc_id", "tk", "n", "cls", "sketch", *COARSE])


def _all_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in byte_slices(batches, 0, SLICE):
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(b.column(0).to_pylist())).view(np.int64))], names=["s"])


def _region_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value  # sorted hashes
        seen: set[int] = set()  # classes this task has dealt already: copies add nothing
        for b in byte_slices(batches, 0, SLICE):
            ss, cc, pp, ff = [], [], [], []
            for x in shingle_sets(b.column(0).to_pylist()):
                if not len(x) or (c := _class_id(x)) in seen:
                    continue
                if len(seen) >= 1 << 20:
                    seen.clear()
                seen.add(c)
                keep = len(x) - -(-3 * len(x) // 4) + 1
                at = np.minimum(np.searchsorted(frequent, x), max(len(frequent) - 1, 0))
                often = frequent[at] == x if len(frequent) else np.zeros(len(x), bool)
                tallied = ~often & (x < COUNTED)
                early, late, last = x[tallied], x[~often & ~tallied], x[often]
                rest = np.concatenate((late, last))[:max(0, keep - len(early))]
                ss += [early, rest]
                ff.append(np.arange(len(early) + len(rest)) >= len(early) + min(len(late), len(rest)))
                pp.append(np.repeat(np.array([max(0, len(early) - keep), -1], np.int32), (len(early), len(rest))))
                cc.append(np.full(len(early) + len(rest), c, np.int64))
            if ss:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ss).view(np.int64)), pa.array(np.concatenate(cc)), pa.array(np.concatenate(pp)), pa.array(np.concatenate(ff))], names=["s", "cls", "spare", "often"])
    return run


def _class_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in byte_slices(batches, 1, SLICE):
        sets = shingle_sets(b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` staged in few files: most of the join's tables are much smaller than the documents."""
    return staged(gathered(df), purpose)


class _Classes:
    """``info`` (cls, n, sketch, ``COARSE``, tk: one text of the class) of all classes, and sets on demand."""

    def __init__(self, docs: DataFrame, info: DataFrame):
        self.docs, self.info, self.sizes = docs, info, sized(_kept(info.select("cls", "n", *COARSE), "jaccard-sizes"))

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``cls`` and one ``text`` of each of the classes ``wanted`` (cls; distinct)."""
        keys = _kept(wanted.join(self.info.select("cls", "tk"), "cls"), "jaccard-wanted")  # narrow; read lazily, so it stays
        return self.docs.join(sized(keys), "tk").select("cls", "text").dropDuplicates(["cls"])

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``cls`` and ``shingles`` of the classes ``wanted`` (cls; distinct)."""
        return _kept(self.texts(wanted).mapInArrow(_class_sets, "cls long, shingles binary"), "jaccard-sets")


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least possible distance of each pair from sizes and sketches."""
    for b in batches:
        na, nb = np.asarray(b.column(2)), np.asarray(b.column(4))
        x = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8) ^ np.frombuffer(b"".join(b.column(5).to_pylist()), np.uint8)
        apart = np.bitwise_count(x.reshape(b.num_rows, -1)).sum(axis=1, dtype=np.int64) if b.num_rows else np.zeros(0, np.int64)
        apart = np.maximum(apart, np.abs(na - nb))
        low = 2 * apart / (na + nb + apart)
        maybe = 100 * (na + nb - apart) >= 75 * (na + nb + apart)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(low), pa.array(maybe)], names=["a", "b", "low", "maybe"])
        b = x = None
        spare()


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 256):
            b = whole.slice(lo, 256)
            dist, link = [], []
            left, right = b.column(2), b.column(3)
            for i in range(b.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (left, right))
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                union = len(both) - common
                dist.append(1 - common / union)
                link.append(100 * common >= 75 * union)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(dist, pa.float64()), pa.array(link, pa.bool_())], names=["a", "b", "dist", "link"])
        whole = b = left = right = x = y = both = None
        spare()


def _apart(a: str, b: str) -> Column:
    """At least so many shingles are in one of two sets only, by sizes and coarse sketches."""
    odd = [F.bit_count(F.col(q + a).bitwiseXOR(F.col(q + b))) for q in COARSE]
    return F.greatest(F.abs(F.col("n" + a) - F.col("n" + b)), sum(odd[1:], odd[0]).cast("long"))


def _can_link(a: str, b: str) -> Column:
    # 100 (both - apart) >= 75 (both + apart)
    return 7 * _apart(a, b) <= F.col("n" + a) + F.col("n" + b)


def _roughly_compared(pairs: DataFrame, classes: _Classes) -> DataFrame:
    """As ``_compared``; only the pairs that narrow sketches leave open get wide ones."""
    side = lambda x: classes.sizes.select(F.col("cls").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", *COARSE)])
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    low = 2 * _apart("_a", "_b") / (F.col("n_a") + F.col("n_b") + _apart("_a", "_b"))
    rough = _kept(met.select("a", "b", low.alias("low"), _can_link("_a", "_b").alias("maybe")), "jaccard-rough")
    near = _compared(rough.where("maybe").select("a", "b"), classes)
    far = rough.where(~F.col("maybe")).select("a", "b", "low", F.lit(1.0).alias("high"), F.lit(False).alias("link"))
    return near.unionByName(far)


def _compared(pairs: DataFrame, classes: _Classes) -> DataFrame:
    """``pairs`` (a, b; distinct) with ``low`` and ``high`` bounds of their distance and ``link``."""
    members = _kept(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "jaccard-paired")
    info = classes.info.join(sized(members), "cls", "left_semi")
    side = lambda x: info.select(F.col("cls").alias(x), F.col("n").alias("n_" + x), F.col("sketch").alias("sketch_" + x))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    bounds = _kept(met.mapInArrow(_bounded, "a long, b long, low double, maybe boolean"), "jaccard-bounds")
    near = bounds.where("maybe").select("a", "b")
    sets = classes.sets(near.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
    of = lambda x: sets.select(F.col("cls").alias(x), F.col("shingles").alias("shingles_" + x))
    done = near.join(of("a"), "a").join(of("b"), "b").select("a", "b", "shingles_a", "shingles_b").mapInArrow(_measured, "a long, b long, dist double, link boolean")
    far = bounds.where(~F.col("maybe")).select("a", "b", "low", F.lit(1.0).alias("high"), F.lit(False).alias("link"))
    out = _kept(done.select("a", "b", F.col("dist").alias("low"), F.col("dist").alias("high"), "link").unionByName(far), "jaccard-pairs")
    freed(members, bounds, sets)
    return out


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (the smallest node reachable) of all nodes of ``edges`` (a, b): smallest
    neighbouring label, then the label's own label, until nothing changes."""
    both = _kept(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    before = labels = _kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "cc-labels")
    while True:
        told = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("told"))
        step = labels.join(told, "node").select("node", F.least("comp", "told").alias("near"), F.col("comp").alias("old"))
        jump = labels.select(F.col("node").alias("near"), F.col("comp").alias("far"))
        new = _kept(step.join(jump, "near", "left").select("node", F.least("near", F.coalesce("far", "near")).alias("comp"), "old"), "cc-labels")
        freed(before)
        before, labels = new, new.select("node", "comp")
        if new.where("comp <> old").isEmpty():
            freed(both)
            return labels


def _regions(rows: DataFrame) -> DataFrame:
    """Rows (s, cls, spare, often) of regions with two classes or more, with the ``pivot`` class.  Rows that are
    not ``often`` meet by shingle; those of a single class go, and of the others each class gives up its ``spare``
    most frequent ones (its unique shingles took their places; -1: the row stays).  Regions of shingles
    known to be frequent are counted before they are shuffled."""
    def shared(df: DataFrame) -> DataFrame:
        own = W.partitionBy("s")
        return df.withColumn("pivot", F.min("cls").over(own)).withColumn("last", F.max("cls").over(own)).where("pivot <> last")

    met = shared(rows.where("NOT often").withColumn("met", F.count("*").over(W.partitionBy("s"))))
    met = met.select("s", "cls", "spare", "met").distinct()
    rank = F.row_number().over(W.partitionBy("cls", "fixed").orderBy(F.desc("met"), F.desc("s")))
    met = met.withColumn("fixed", F.col("spare") < 0).withColumn("rank", rank).where("rank > spare")
    cold = shared(met.select("s", "cls")).select("s", "cls", "pivot")
    often = rows.where("often").select("s", "cls").distinct()
    heads = often.groupBy("s").agg(F.min("cls").alias("pivot"), F.max("cls").alias("last")).where("pivot <> last").select("s", "pivot")
    return cold.unionByName(often.join(heads, "s").select("s", "cls", "pivot"))


def _dealt(docs: DataFrame, late: np.ndarray) -> DataFrame:
    """Regions of ``docs`` (text) with the shingles ``late`` (sorted hashes) last in the order."""
    shared = docs.sparkSession.sparkContext.broadcast(late)
    rows = docs.select("text").mapInArrow(_region_rows(shared), "s long, cls long, spare int, often boolean")
    return _kept(_regions(rows), "jaccard-dealt")


def _distinct(every: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One region of ``every`` for each set of members; and all shingles ``s`` with ``head``, the region that
    stands for theirs, and ``c`` members."""
    marks = [F.bit_xor(F.xxhash64("cls", F.lit(seed))).alias(f"mark{seed}") for seed in range(2)]
    members = _kept(every.groupBy("s").agg(F.count("*").alias("c"), *marks), "jaccard-members")
    heads = _kept(members.groupBy("c", "mark0", "mark1").agg(F.min("s").alias("head")), "jaccard-heads")
    same = _kept(members.join(heads, ["c", "mark0", "mark1"]).select("s", "head", "c"), "jaccard-same")
    regions = _kept(every.join(heads.select(F.col("head").alias("s")), "s", "left_semi"), "jaccard-regions")
    freed(every, members, heads)
    return regions, same


def _hashes(rows: DataFrame) -> np.ndarray:
    """At most ``FREQUENT`` shingles ``s``, those with the largest ``c`` first.  As Arrow, the best rows of the
    partitions meet in a task; ``collect`` would merge them in the driver."""
    got = rows.orderBy(F.desc("c"), "s").limit(FREQUENT).select("s").toArrow()
    return got.column("s").to_numpy().astype(np.int64).view(np.uint64)


def links(docs: DataFrame, info: DataFrame, complete: bool = False) -> DataFrame:
    """Linked pairs of classes that connect every component of the join (and only linked pairs), or
    with ``complete`` all linked pairs, once each.  ``docs``: text, tk; ``info``: cls, n, sketch, tk."""
    edges = _links(docs, info, complete)
    return edges.distinct() if complete else edges


def _links(docs: DataFrame, info: DataFrame, complete: bool) -> DataFrame:
    on_workers(docs)
    picked = info.select("tk").orderBy(F.xxhash64("tk"), "tk").limit(SAMPLE_DOCS)
    sample = gathered(docs.join(F.broadcast(picked), "tk").dropDuplicates(["tk"]).select("text"))
    late = np.sort(_hashes(sample.mapInArrow(_all_shingles, "s long").groupBy("s").agg(F.count("*").alias("c")).where(F.col("c") >= FREQUENT_FROM)))
    classes, edges, (regions, same) = _Classes(docs, info), None, _distinct(_dealt(docs, late))
    met = float("inf")
    for level in range(LEVELS):
        star, edges = _star(regions, classes, edges, complete)
        edges, wide, met = _join_regions(regions, star, classes, edges, level + 1 == LEVELS, complete, met)
        if wide is None:
            return edges
        heads = wide.select(F.col("s").alias("head")).distinct()
        later = np.union1d(late, _hashes(same.join(heads, "head", "left_semi")))
        if len(later) == len(late):  # the order cannot be improved
            return _join_regions(regions, star, classes, edges, True, complete)[0]
        dealt = _distinct(_dealt(classes.texts(wide.select("cls").distinct()), later))
        freed(regions, same)
        late, (regions, same) = later, dealt
    return edges


def _labelled(regions: DataFrame, edges: DataFrame | None) -> DataFrame:
    """Rows of the regions that hold more than one component (without edges each class is one); ``main`` is a
    region's largest component."""
    if edges is None:
        rows = regions.withColumn("comp", F.col("cls"))
    else:
        comp = components(edges)
        rows = regions.join(sized(comp.withColumnRenamed("node", "cls")), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    each = rows.groupBy("s", "comp").agg(F.count("*").alias("k")).groupBy("s").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"), F.count("*").alias("m"), F.max(F.struct("k", "comp")).alias("top"))
    open_ = _kept(each.where("m > 1").select("s", "k", "kk", F.col("top.comp").alias("main")), "jaccard-open")
    out = _kept(rows.join(sized(open_), "s"), "jaccard-labelled")
    freed(open_)
    return out


def _wide() -> Column:
    """A region has k members and k * k - kk pairs (both ways round) of members of different components."""
    return F.col("k") * F.col("k") - F.col("kk") > 2 * WIDE * F.col("k")


def _star(regions: DataFrame, classes: _Classes, edges: DataFrame | None, complete: bool) -> tuple[DataFrame, DataFrame]:
    """All members compared with their region's pivot, and all links found so far."""
    star = regions.where("cls <> pivot").select(F.col("pivot").alias("a"), F.col("cls").alias("b")).distinct()
    star = _roughly_compared(star, classes)
    found = star.where("link").select("a", "b")
    edges = found if edges is None else edges.unionByName(found)
    return star, edges if complete else _further_pivots(regions, classes, edges)


def _further_pivots(regions: DataFrame, classes: _Classes, edges: DataFrame) -> DataFrame:
    """``edges`` and the links of members of wide regions to further pivots.  Pivots are elected by hash, so regions
    that share members mostly elect the same ones."""
    before = None
    for turn in range(TURNS):
        rows = _labelled(regions, edges)
        names = [f"p{i}" for i in range(PIVOTS)]
        elected = [F.min_by("cls", F.xxhash64("cls", F.lit(turn * PIVOTS + i))).alias(p) for i, p in enumerate(names)]
        top = rows.where(_wide() & (F.col("comp") == F.col("main"))).groupBy("s").agg(F.count("*").alias("m"), *elected)
        top = top.select("s", "m", F.array_distinct(F.array(*names)).alias("pivots"))
        if before is not None:
            top = top.join(before.select("s", F.col("m").alias("was")), "s").where("m > was").drop("was")
        top = _kept(top, "jaccard-elected")
        outside = rows.where("comp <> main").join(sized(top), "s").select(F.explode("pivots").alias("a"), F.col("cls").alias("b"))
        pairs = _kept(outside.distinct(), "jaccard-turn")
        freed(rows, *([] if before is None else [before]))
        before = top
        if pairs.isEmpty():
            break
        edges = edges.unionByName(_roughly_compared(pairs, classes).where("link").select("a", "b"))
        freed(pairs)
    freed(before)
    return edges


def _join_regions(regions: DataFrame, star: DataFrame, classes: _Classes, edges: DataFrame, last: bool, complete: bool = False, before: float = float("inf")) -> tuple[DataFrame, DataFrame | None, float]:
    """All links found so far, the rows (s, cls) that have to be dealt anew (None: none), and the number of pairs of
    different components in their regions; with more than half of the pairs ``before`` none is dealt anew."""
    rows = _labelled(regions, None if complete else edges)
    if rows.isEmpty():
        return edges, None, 0.0
    wide = _wide()
    met = rows.where(wide).agg(F.sum((F.col("k") - F.col("kk") / F.col("k")) / 2)).first()[0] or 0.0
    last = last or met > before / 2
    far = star.select(F.col("a").alias("pivot"), F.col("b").alias("cls"), "low", "high")
    placed = rows.join(sized(far), ["pivot", "cls"], "left").join(classes.sizes, "cls")
    placed = _kept(placed.select("s", "cls", "comp", "main", "n", *COARSE, (wide & F.lit(not last)).alias("wide"), F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(0.0)).alias("high")), "jaccard-placed")
    freed(rows)
    narrow = placed.where("NOT wide")
    rank = F.row_number().over(W.partitionBy("cls").orderBy("s"))
    first = narrow.select("cls", "s").withColumn("rank", rank).where(F.col("rank") <= LISTED)
    listed = first.groupBy("cls").agg(F.array_sort(F.collect_list("s")).alias("own"))
    narrow = _kept(narrow.join(listed, "cls"), "jaccard-narrow")
    one, two = (narrow.select("s", "main", *[F.col(c).alias(c + x) for c in ("cls", "comp", "low", "high", "n", "own", *COARSE)]) for x in ("1", "2"))
    slack = EPS + 1e-9
    # Members of the largest component are met by the others only.
    window = one.where("comp1 <> main").join(two.drop("main"), "s").where(
        (F.col("comp1") != F.col("comp2")) & ((F.col("comp2") == F.col("main")) | (F.col("cls1") < F.col("cls2")))
        & (F.col("low1") - F.col("high2") <= slack) & (F.col("low2") - F.col("high1") <= slack)
        & (100 * F.least("n1", "n2") >= 75 * F.greatest("n1", "n2")) & _can_link("1", "2")
        & (F.coalesce(F.try_element_at(F.array_intersect("own1", "own2"), F.lit(1)), F.col("s")) >= F.col("s")))
    pairs = window.select(F.least("cls1", "cls2").alias("a"), F.greatest("cls1", "cls2").alias("b")).distinct()
    known = star.select("a", "b")
    pairs = _kept(pairs.join(known, ["a", "b"], "left_anti"), "jaccard-window")
    freed(narrow)
    edges = edges.unionByName(_compared(pairs, classes).where("link").select("a", "b"))
    left = placed.where("wide").select("s", "cls")
    return edges, None if left.isEmpty() else left, met


def _classed(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``df`` as doc_id, tk (hash of the text), text; its rows with their class; and the classes."""
    src = df.select(df[f"`{id_col}`"].alias("doc_id"), F.xxhash64(df[f"`{text_col}`"]).alias("tk"), df[f"`{text_col}`"].alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    rows = staged(on_workers(src).mapInArrow(_classes, f"doc_id {kind}, tk long, n long, cls long, sketch binary, " + ", ".join(f"{q} long" for q in COARSE)), "jaccard-classes")
    worded = rows.where("cls IS NOT NULL")
    info = worded.groupBy("cls").agg(F.min("tk").alias("tk"), F.min("n").alias("n"), F.min("sketch").alias("sketch"), *[F.min(q).alias(q) for q in COARSE], F.min("doc_id").alias("low"))
    return src, rows, _kept(info, "jaccard-info")


def _joined(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: ``doc_id``, ``tk`` (hash of the text), ``n``, ``cls`` (null: no words), ``comp`` and ``low``, the
    component's smallest id."""
    src, rows, info = _classed(df, id_col, text_col)
    worded = rows.where("cls IS NOT NULL")
    edges = links(src.where("text IS NOT NULL").select("tk", "text"), info.drop("low"))
    heads = info.select("cls", "low").join(components(edges).withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    lows = heads.groupBy("comp").agg(F.min("low").alias("low"))
    named = _kept(heads.select("cls", "comp").join(lows, "comp"), "jaccard-named")
    alone = rows.where("cls IS NULL").select("doc_id", "tk", "n", "cls", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("low"))
    return worded.select("doc_id", "tk", "n", "cls").join(named, "cls").select("doc_id", "tk", "n", "cls", "comp", "low").unionByName(alone)


def join_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``class_id`` (equal sets) and ``component_id``, the smallest
    id reachable by links."""
    return _joined(df, id_col, text_col).select("doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), F.col("low").alias("component_id"))


def join_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``class_id`` and ``n_links``, the number of other rows within ``EPS`` of it
    (rows of its own class included).  All linked pairs of classes are made, so the work grows with
    their number."""
    src, rows, info = _classed(df, id_col, text_col)
    edges = _kept(links(src.where("text IS NOT NULL").select("tk", "text"), info.drop("low"), complete=True), "jaccard-links")
    members = _kept(rows.where("cls IS NOT NULL").groupBy("cls").agg(F.count("*").alias("rows")), "jaccard-members")
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = both.join(members.withColumnRenamed("cls", "b"), "b").groupBy(F.col("a").alias("cls")).agg(F.sum("rows").alias("others"))
    counts = members.join(others, "cls", "left").select("cls", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return rows.join(counts, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns as they are, without those that are linked, directly or not, to
    a row that stays: of each component the row with the smallest id (null last), then the smallest
    hash of its text; of rows equal in both one stays.  Rows without words all stay."""
    rows = _kept(_joined(df, id_col, text_col).select("doc_id", "tk", "comp"), "jaccard-rows")
    grouped = rows.where("comp IS NOT NULL").groupBy("comp", "doc_id", "tk").agg(F.count("*").alias("k"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tk", "k"))
    heads = grouped.groupBy("comp").agg(first.alias("h"), F.count("*").alias("m")).where("m > 1 OR h.k > 1")
    heads = _kept(heads.select("comp", F.col("h.doc_id").alias("h_id"), F.col("h.tk").alias("h_tk"), F.col("h.k").alias("k")), "jaccard-heads")
    same = grouped["doc_id"].eqNullSafe(heads["h_id"]) & (grouped["tk"] == heads["h_tk"])
    go = _kept(grouped.join(heads, "comp").where(~same).select("doc_id", "tk"), "jaccard-go")
    again = _kept(heads.where("k > 1").select(F.col("h_id").alias("doc_id"), F.col("h_tk").alias("tk")), "jaccard-again")
    # All columns travel in one struct, so no name can clash.
    src = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("_row"), df[f"`{id_col}`"].alias("_id"), F.xxhash64(df[f"`{text_col}`"]).alias("_tk"))
    matches = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_tk") == F.col("tk"))
    kept = src.join(sized(go), matches, "left_anti")
    once = kept.join(sized(again), matches, "left_anti").select("_row.*")
    return once.unionByName(gathered(kept.join(sized(again), matches, "left_semi").dropDuplicates(["_id", "_tk"])).select("_row.*"))
