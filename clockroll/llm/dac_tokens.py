"""Operator 7: token ids as directly addressable codes (DAC), written to and read from files.

Texts become ids with a tokenizer file, an end id closes each document, and the ids of all
documents, in ascending document id, form one long sequence.  The sequence is stored in
segments.  Within a segment each id is cut into 8-bit chunks, lowest first.  Level 1 holds
the first chunk of every id, level 2 the second chunk of those ids that have one, and so on.
A level's continuation bitmap says which of its entries go on, and its rank directory (ones
before every 512th bit) turns an entry's place into the place of its next chunk.  So token
``i`` is read with one look-up per level, and a document's ids are one slice per level; no
block is ever decoded from its start.

Segment bytes (little-endian), fixed format::

    "DAC1"  u32 levels  u64 tokens
    per level: u64 entries, the chunks (u8), and, unless it is the last level,
               ceil(entries / 8) bytes of bitmap (bit j of byte j // 8), and
               u32 ones-before for each started block of 512 entries

The files are a Parquet table with one row per segment (``part``, ``first``: tokens before
it in its part, document ids and lengths, and the segment bytes), so Spark's commit protocol
covers lost executors and the path may be in any store that Spark reaches.

Defined cases: a null or empty text is only the end id; null document ids come first; rows
with equal ids are ordered by text; an empty table gives an empty table of segments.  Added
tokens inside a text get their ids, as the library does by default.
"""

from __future__ import annotations

import codecs
import os
import re
import struct
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from clockroll.llm.common import byte_slices, on_workers

BLOCK = 512
SEGMENT_TOKENS = 1 << 20
WORDS_KEPT = 800_000
#: Tokens of neighbouring documents that are read from a segment at a time.
READ_TOKENS = 1 << 18
SEGMENT_SCHEMA = "part int, first long, n_tokens long, doc_ids array<long>, lengths array<long>, codes binary"


def pack(ids: np.ndarray) -> bytes:
    """The segment bytes of unsigned 32-bit ids."""
    out, rest, levels = [], ids.astype(np.uint32), 0
    while True:
        levels += 1
        more = rest > 0xFF
        out.append(struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes())
        if not more.any():
            break
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK)).astype(np.uint32)
        before = np.concatenate(([0], np.cumsum(ones[:-1]))).astype("<u4")
        out.append(np.packbits(more, bitorder="little").tobytes() + before.tobytes())
        rest = rest[more] >> 8
    return b"DAC1" + struct.pack("<IQ", levels, len(ids)) + b"".join(out)


class Segment:
    """Reads tokens of packed bytes in place."""

    def __init__(self, data: bytes):
        if data[:4] != b"DAC1":
            raise ValueError("not a DAC segment")
        levels, self.n = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for k in range(levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            at += 8 + n
            if k + 1 < levels:
                bits = np.frombuffer(data, np.uint8, (n + 7) // 8, at)
                before = np.frombuffer(data, "<u4", -(-n // BLOCK), at + len(bits))
                at += len(bits) + 4 * len(before)
                self.levels.append((chunks, bits, before))
            else:
                self.levels.append((chunks, None, None))

    def rank(self, level: int, i: int) -> int:
        """Entries before place ``i`` of a level that go on: the directory plus one block's bits."""
        chunks, bits, before = self.levels[level]
        if i >= len(chunks):
            return len(self.levels[level + 1][0])
        lo = i // BLOCK * BLOCK // 8
        own = np.unpackbits(bits[lo:i // 8 + 1], bitorder="little")[: i - lo * 8]
        return int(before[i // BLOCK]) + int(own.sum())

    def token(self, i: int) -> int:
        """Token ``i``: one chunk per level."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value, shift = 0, 0
        for k, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if bits is None or not bits[i >> 3] >> (i & 7) & 1:
                break
            i, shift = self.rank(k, i), shift + 8
        return value

    def tokens(self, start: int, n: int) -> np.ndarray:
        """Tokens ``start`` to ``start + n``: one slice per level."""
        out, place, lo, hi = np.zeros(n, dtype="<u4"), np.arange(n), start, start + n
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[place] |= chunks[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            if bits is None or lo == hi:
                break
            base = lo // 8
            more = np.unpackbits(bits[base:(hi + 7) // 8], bitorder="little")[lo - base * 8: hi - base * 8].astype(bool)
            lo, hi = self.rank(k, lo), self.rank(k, hi)
            place = place[more]
        return out


_built: list = []

#: The pieces into which the known tokenizer splits a text; marks of ASCII; and the pieces for words of printable ASCII in lower case.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class _Words(dict):
    """Word -> its ids as bytes, for a tokenizer in which white space never joins two words.  Words are kept in two
    halves: when the new one is full it becomes the old one, whose words come back when they are met again."""

    def __init__(self, tokenizer, byte_level: str | None, known_split: bool):
        super().__init__({"": b""})
        self.before: dict[str, bytes] = {}
        self.tokenizer, self.merge, self.shown, self.known_split = tokenizer, tokenizer.model.tokenize, byte_level, known_split

    def __missing__(self, w: str) -> bytes:
        got = self.before.get(w)
        if got is None:
            got = self._ids(w)
        if len(w) <= 64:
            if len(self) >= WORDS_KEPT // 2:
                self.before = dict(self)
                self.clear()
                self[""] = b""
            self[w] = got
        return got

    def _ids(self, w: str) -> bytes:
        # Letters in their final form: lower case, composed.
        if self.shown and w == w.lower() and (w.isascii() or is_normalized("NFC", w)):
            if w.isalpha():  # straight to the merge model
                return self._merged(w if w.isascii() else codecs.charmap_decode(w.encode(), "strict", self.shown)[0])
            if self.known_split:
                letters = w.rstrip(MARKS)
                if letters.isalpha() and letters != w:  # marks after letters are one piece
                    return self[letters] + self[w[len(letters):]]
                if w.isascii() and w.isprintable():  # shows as itself
                    pieces = _PIECES.findall(w)
                    return b"".join([self[p] for p in pieces]) if len(pieces) > 1 else self._merged(w)
        # A mark after a letter is a token of its own (where the letter's lower case ends in a sign
        # that is no letter, the mark belongs to that sign's token).
        if len(w) > 1 and w[-1] in ",." and w[-2].isalpha() and len(w[-2].lower()) == 1:
            return self[w[:-1]] + self[w[-1]]
        return array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()

    def _merged(self, shown: str) -> bytes:
        return array("I", [t.id for t in self.merge(shown)]).tobytes()


class _Encoder:
    """Ids of texts.  Words are encoded once and looked up again where the tokenizer's steps allow
    it; texts with an added token, and all texts if the tokenizer is of another kind, go to it whole."""

    def __init__(self, tokenizer_json: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.end = np.uint32(end_id).tobytes()
        spec = json.loads(tokenizer_json)
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.lowers = steps == ["NFC", "Replace", "Lowercase"]
        # The byte-level step shows each byte as a character: printable ones as themselves, the
        # others as the characters from 256 on, in order.
        kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
        moved = (b for b in range(256) if b not in kept)
        known = self.lowers and [x.get("type") for x in pre] == ["Split", "ByteLevel"]
        shown = {b: chr(256 + i) for i, b in enumerate(moved)}
        byte_level = "".join(shown.get(b, chr(b)) for b in range(256)) if known else None
        # Tokens that the library looks for in the text as it stands, before any other step.
        added = spec.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        as_is = all(t["special"] and not t["normalized"] for t in added)
        self.by_word = as_is and pre[0].get("type") == "Split" and pre[0].get("behavior") == "Removed" and pre[0].get("invert") and r"[^\s" in pre[0].get("pattern", {}).get("Regex", "")
        # A word in lower case may read like an added token that the text does not hold.
        self.tokenizer.encode_special_tokens = self.by_word
        self.words = _Words(self.tokenizer, byte_level, known and pre[0].get("pattern", {}).get("Regex") == SPLIT)

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [np.array(e.ids, dtype="<u4").tobytes() + self.end for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        return [self._ids(t) + self.end for t in texts]

    def _ids(self, text: str) -> bytes:
        if any(x in text for x in self.added):
            self.tokenizer.encode_special_tokens = False
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            self.tokenizer.encode_special_tokens = True
            return np.array(ids, dtype="<u4").tobytes()
        words = self._plain(text).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.words.__getitem__, words))

    def _plain(self, text: str) -> str:
        """The text in lower case, where the tokenizer's own steps (NFC, then lower case for each
        character) give just that; else the text."""
        if not self.lowers:
            return text
        low = text.lower()
        if text.isascii():
            return low
        plain = "\u03a3" not in text and is_normalized("NFC", text) and is_normalized("NFC", low)
        return low if plain else text


def _write_batches(shared, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _built or _built[0] is not shared:
            _built[:] = [shared, _Encoder(shared.value, end_id)]
        encoder, part = _built[1], TaskContext.get().partitionId()
        first, held, docs, lengths = 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal first
            n = sum(lengths)
            row = {"part": [part], "first": [first], "n_tokens": [n], "doc_ids": [list(docs)], "lengths": [list(lengths)],
                   "codes": [pack(np.frombuffer(b"".join(held), dtype="<u4"))]}
            first += n
            for x in (held, docs, lengths):
                x.clear()
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("part", pa.int32()), ("first", pa.int64()), ("n_tokens", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("codes", pa.binary())]))

        for s in byte_slices(batches, 1):
            for doc, ids in zip(s.column(0).to_pylist(), encoder(s.column(1).to_pylist()), strict=True):
                docs.append(doc)
                lengths.append(len(ids) // 4)
                held.append(ids)
            if sum(lengths) >= SEGMENT_TOKENS:
                yield flush()
        if docs:
            yield flush()
    return run


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> None:
    """Encode every text and write the segments of all documents, in ascending id, to ``path``."""
    spark = on_workers(df).sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary file on the driver, bounded
        shared = spark.sparkContext.broadcast(f.read())
    src = df.select(df[f"`{id_col}`"].cast("long").alias("id"), F.coalesce(df[f"`{text_col}`"], F.lit("")).alias("text"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")  # splits a run of equal ids between parts
    ordered = src.repartitionByRange(parts, F.col("id").asc_nulls_first(), tie).sortWithinPartitions(F.col("id").asc_nulls_first(), tie, "text")
    ordered.mapInArrow(_write_batches(shared, end_id), SEGMENT_SCHEMA).write.parquet(path)


def segments(spark, path: str) -> DataFrame:
    """The files at ``path`` with ``start``: tokens of all segments before each one.  The offsets
    come from one row per writing task."""
    t = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    sums = t.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    offs = sums.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("off"))
    return t.join(F.broadcast(offs), "part").withColumn("start", F.col("off") + F.col("first")).drop("off")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of segments (doc_ids, lengths, start, codes).  Neighbours are one slice: about
    ``READ_TOKENS`` at a time, a longer document alone."""
    for b in batches:
        for r in range(b.num_rows):
            seg, at = Segment(b.column(3)[r].as_buffer().to_pybytes()), 0
            docs, lens, start = b.column(0)[r].as_py(), b.column(1)[r].as_py(), b.column(2)[r].as_py()
            begins = np.concatenate(([0], np.cumsum(lens, dtype=np.int64)))
            while at < len(docs):
                hi = max(at + 1, int(np.searchsorted(begins, begins[at] + READ_TOKENS, side="right")) - 1)
                ids = seg.tokens(int(begins[at]), int(begins[hi] - begins[at]))
                ends = (4 * (begins[at:hi + 1] - begins[at])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[at:hi], pa.int64()), pa.array(begins[at:hi] + start), pa.array(lens[at:hi], pa.int64()),
                     pa.Array.from_buffers(pa.binary(), hi - at, [None, pa.py_buffer(ends), pa.py_buffer(ids)])],
                    names=["doc_id", "start", "n_tokens", "ids"])
                at = hi


def read_documents(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (the
    little-endian unsigned 32-bit ids as binary)."""
    src = segments(spark, path).select("doc_ids", "lengths", "start", "codes")
    return on_workers(src).mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(positions: DataFrame, spark, path: str, position_col: str = "position") -> DataFrame:
    """``position`` and ``token``: random access to a query's positions in the whole sequence.
    Each position meets only its own segment (join on ranges of one segment length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, codes = b.column(1).to_pylist(), b.column(2)
            got = [Segment(codes[r].as_buffer().to_pybytes()).token(at[r]) for r in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.int64())], names=["position", "token"])
    cell = lambda c: F.floor(c / SEGMENT_TOKENS)
    segs = segments(spark, path).withColumn("cell", F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n_tokens") - 1))))
    want = positions.select(positions[f"`{position_col}`"].cast("long").alias("position"))
    hit = want.join(segs, (cell(want["position"]) == segs["cell"]) & (want["position"] >= segs["start"]) & (want["position"] < segs["start"] + segs["n_tokens"]))
    return hit.select("position", (F.col("position") - F.col("start")).alias("at"), "codes").mapInArrow(run, "position long, token long")


def digests(documents: DataFrame) -> DataFrame:
    """``ids_crc32`` instead of the ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
