"""Operator 6: exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

The library merges the best-scored adjacent pair until none is left.  The same result is
found from left to right without a merge queue:

* an Aho-Corasick automaton over the reversed pieces gives the longest piece that starts at
  each character;
* a piece may follow its predecessor only if merging could not have crossed the border
  between them; that is checked by undoing the merges on both sides of the border, latest
  first (``MergeTable.compatible``);
* a piece that does not fit is replaced by the next shorter piece at the same place, and a
  place where none fits is marked in a bitfield of failed positions and never tried again.

No piece holds a blank mark after another character, so a text is the concatenation of its
blank-led words and equal words are encoded once (``WordIds``).  Characters without a piece
become their UTF-8 byte pieces.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to ""; each
row stands alone, so nulls in other columns, repeated rows and ties have no influence.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from clockroll.llm.common import byte_slices, held, on_workers

BLANK = "▁"
#: Words, and pairs of pieces, that a worker meets before it forgets those that it did not meet among as many
#: before them (memory bound, not a result bound).
WORDS_KEPT = 200_000
PAIRS_KEPT = 200_000


def read_model(path: str) -> dict:
    """Pieces, scores and kinds of a SentencePiece model file (bounded by its vocabulary)."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    return {
        "pieces": [sp.id_to_piece(i) for i in range(n)],
        "scores": [sp.get_score(i) for i in range(n)],
        "bytes": [i for i in range(n) if sp.is_byte(i)],
        "special": [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)],
    }


class MergeTable:
    """Pieces by merge order: single characters first, then by falling score.  A piece's
    ``left`` and ``right`` are the two pieces of its last merge (itself for a character)."""

    def __init__(self, model: dict):
        skip = {*model["bytes"], *model["special"]}
        known = [(p, s, i) for i, (p, s) in enumerate(zip(model["pieces"], model["scores"], strict=True)) if i not in skip]
        chars = sorted(x for x in known if len(x[0]) == 1)
        # Runs of blanks share one score; `blank_run` merges those, leftmost first.
        self.runs = {len(p): (s, i) for p, s, i in known if p.strip(BLANK) == ""}
        multi = sorted((x for x in known if len(x[0]) > 1 and x[0].strip(BLANK)), key=lambda x: (-x[1], x[2]))
        if any(BLANK in p[1:] for p, _, _ in multi):
            raise ValueError("a piece holds a blank mark after another character")
        order = chars + multi
        self.text = [p for p, _, _ in order]
        self.ids = [i for _, _, i in order]
        self.byte_ids = model["bytes"]
        self.number = {p: k for k, p in enumerate(self.text)}
        self.left, self.right = list(range(len(order))), list(range(len(order)))
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}  # by the pair's number, a * pieces + b
        self.pairs_kept = PAIRS_KEPT
        self.fitted: dict[int, bool] = {}  # of the pairs met before those in `fits`
        dead = []
        for k in range(len(chars), len(order)):
            halves = self._last_merge(k)
            if halves is None:
                dead.append(k)
                continue
            self.left[k], self.right[k] = halves
            self.merged[halves] = k
        for k in dead:  # never the outcome of merging
            del self.number[self.text[k]]
        self.shorter: list[int | None] = [next((self.number[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in self.number), None) for p in self.text]
        self.starts = ahocorasick.Automaton()
        for p, k in self.number.items():
            self.starts.add_word(p[::-1], k)
        self.starts.make_automaton()
        # Characters that stand side by side in some piece; a text can be cut everywhere else.
        self.joined = {p[i:i + 2] for p in self.number for i in range(len(p) - 1)}
        self.size = [len(p) for p in self.text]
        self.code = [np.int32(i).tobytes() for i in self.ids]
        self.byte_code = [np.int32(i).tobytes() for i in self.byte_ids]

    def _last_merge(self, k: int) -> tuple[int, int] | None:
        """The halves whose merge makes piece ``k``: earlier pieces that may stand side by side."""
        p = self.text[k]
        for n in range(1, len(p)):
            a, b = self.number.get(p[:n]), self.number.get(p[n:])
            if a is not None and b is not None and a < k and b < k and self.compatible(a, b):
                return a, b
        return None

    def may_follow(self, a: int, b: int) -> bool:
        """``compatible``, remembered for the pairs met so far."""
        pair = a * len(self.text) + b
        got = self.fits.get(pair)
        if got is None:
            if (got := self.fitted.get(pair)) is None:
                got = self.compatible(a, b)
            if len(self.fits) >= self.pairs_kept:
                self.fitted, self.fits = self.fits, {}
            self.fits[pair] = got
        return got

    def compatible(self, a: int, b: int) -> bool:
        """May ``b`` follow ``a``, that is, does no merge across their border come before one
        of the merges that built them?"""
        merged, left, right = self.merged, self.left, self.right
        before = len(self.text)  # merges from this number on come too late to cross the border
        while True:
            if merged.get((a, b), before) < before:
                return False
            # Undo whichever side was completed last; on a tie the right one, as equal
            # merges run from left to right.
            if a > b:
                if right[a] == a:
                    return True
                before, a = a, right[a]
            elif left[b] != b:
                before, b = b + 1, left[b]
            elif right[a] != a:
                before, a = a, right[a]
            else:
                return True

    def encode(self, s: str) -> list[int]:
        """Piece numbers of a string whose characters all have pieces."""
        n = len(s)
        if s in self.number:
            k = self.number[s]
            return [k]
        longest, top = [-1] * n, n - 1
        for end, k in self.starts.iter(s[::-1]):  # at each place the longest match comes first
            if longest[top - end] < 0:
                longest[top - end] = k
        failed = bytearray((n >> 3) + 1)  # one bit for each position
        size, shorter, may_follow = self.size, self.shorter, self.may_follow
        out: list[int] = []
        at, k = 0, longest[0]
        while True:
            end = at + size[k]
            if not failed[end >> 3] >> (end & 7) & 1 and (not out or may_follow(out[-1], k)):
                out.append(k)
                if end == n:
                    return out
                at, k = end, longest[end]
            elif shorter[k] is not None:
                k = shorter[k]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                k = out.pop()
                at -= size[k]

    def blank_run(self, n: int) -> list[int]:
        """Ids of ``n`` blank marks that nothing else merges with: best score, then leftmost."""
        size, nxt, prv = [1] * n, [*range(1, n + 1)], [*range(-1, n - 1)]
        heap: list[tuple[float, int, int, int]] = []

        def offer(i: int) -> None:
            if 0 <= i and nxt[i] < n and (run := self.runs.get(size[i] + size[nxt[i]])):
                heapq.heappush(heap, (-run[0], i, size[i], size[nxt[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            if size[i] != a or nxt[i] >= n or size[nxt[i]] != b:
                continue
            j = nxt[i]
            size[i], size[j], nxt[i] = a + b, 0, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            offer(i)
            offer(prv[i])
        return [self.runs[x][1] for x in size if x]


class WordIds(dict):
    """String -> its ids as int32 bytes; ``lead`` is put before each string.  Strings are cut
    where no piece holds the two characters side by side, and the parts are looked up in turn."""

    def __init__(self, table: MergeTable, lead: str = "", parts: WordIds | None = None, kept: int | None = None):
        super().__init__()
        self.table, self.lead, self.parts = table, lead, self if parts is None else parts
        self.kept = WORDS_KEPT if kept is None else kept
        self.before: dict[str, bytes] = {}  # the words met before those held

    def clear(self) -> None:
        super().clear()
        self.before = {}

    def __missing__(self, word: str) -> bytes:
        got = self.before.get(word)
        if got is None:
            got = self._coded(word)
        if len(word) <= 64:
            if len(self) >= self.kept:
                before = dict(self)
                self.clear()
                self.before = before
            self[word] = got
        return got

    def _coded(self, word: str) -> bytes:
        t, s = self.table, self.lead + word
        cut = len(s) - 1
        while cut > 0 and s[cut - 1:cut + 1] in t.joined:
            cut -= 1
        if cut > len(self.lead):  # the head with its lead, the rest without
            if len(word) > 200:
                return self._long(s)
            return self[s[len(self.lead):cut]] + self.parts[s[cut:]]
        if cut:
            return self.parts[self.lead] + self.parts[word]
        if len(s) == 1 and s not in t.number:
            return b"".join([t.byte_code[x] for x in s.encode()])
        return b"".join([t.code[k] for k in t.encode(s)])

    def _long(self, s: str) -> bytes:
        joined, out, start = self.table.joined, [], 0
        for i in range(1, len(s) + 1):
            if i == len(s) or s[i - 1:i + 1] not in joined:
                out.append(self.parts[s[start:i]])
                start = i
        return b"".join(out)


class Codec:
    """Encodes and decodes one text at a time; built once in each worker.  ``kept`` words and pairs
    instead of ``WORDS_KEPT`` and ``PAIRS_KEPT`` take less memory and more time."""

    def __init__(self, model: dict, kept: int | None = None):
        self.table = MergeTable(model)
        self.words = WordIds(self.table, BLANK, WordIds(self.table, kept=kept), kept)
        if kept is not None:
            self.table.pairs_kept = kept
        self.runs: dict[int, bytes] = {}
        if any(s >= min(sc for p, sc in zip(model["pieces"], model["scores"], strict=True) if len(p) > 1 and p.strip(BLANK) and sc > -1e8)
               for s, _ in (x for n, x in self.table.runs.items() if n > 1)):
            raise ValueError("runs of blanks must merge after everything else")
        self.shown = np.array([None if i in set(model["special"]) else p for i, p in enumerate(model["pieces"])], dtype=object)
        self.byte_of = {i: b for b, i in enumerate(model["bytes"])}
        self.first_byte, self.last_byte = min(model["bytes"], default=0), max(model["bytes"], default=-1)

    def forget(self) -> None:
        """Drops the words and pairs met so far; the tables stay."""
        for met in (self.words, self.words.parts, self.table.fits, self.table.fitted):
            met.clear()

    def _run(self, n: int) -> bytes:
        if n not in self.runs:
            if len(self.runs) > 1000:
                self.runs.clear()
            self.runs[n] = np.array(self.table.blank_run(n), dtype=np.int32).tobytes()
        return self.runs[n]

    def encode(self, text: str | None) -> bytes:
        """The text's ids as little-endian int32."""
        if not text:
            return b""
        words = text.replace(BLANK, " ").split(" ")
        if "" not in words:
            return b"".join(map(self.words.__getitem__, words))
        out, wait = [], 0  # `wait` blank marks stand before the next word's own one
        alone = np.int32(self.table.runs[1][1]).tobytes()
        for w in words:
            if not w:
                wait += 1
                continue
            ids = self.words[w]
            if wait and ids[:4] == alone:  # the word's blank mark merges with no letter
                out += [self._run(wait + 1), ids[4:]]
            else:
                out += [self._run(wait), ids] if wait else [ids]
            wait = 0
        return b"".join([*out, self._run(wait)] if wait else out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, blank marks to blanks, the leading one dropped."""
        if not len(ids):
            return ""
        as_bytes = (ids >= self.first_byte) & (ids <= self.last_byte)
        shown = self.shown[ids]
        if as_bytes.any():
            shown = shown.copy()
            edges = np.flatnonzero(np.diff(np.concatenate(([0], as_bytes.view(np.int8), [0]))))
            for a, b in zip(edges[::2], edges[1::2], strict=True):
                raw = bytes(self.byte_of[i] for i in ids[a:b].tolist())
                shown[a] = raw.decode(errors="replace")
                shown[a + 1:b] = ""
        s = "".join(x for x in shown.tolist() if x is not None).replace(BLANK, " ")
        return s.removeprefix(" ") if not as_bytes[0] else s


def _few_ids(batches: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Rows with about ``limit`` ids at a time, so that a worker holds the texts of those only."""
    for b in batches:
        upto, lo = np.cumsum(np.diff(np.asarray(b.column(column).offsets)).astype(np.int64) + 16), 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + limit, side="right")))
            yield b.slice(lo, hi - lo)
            lo = hi
        b = None


def _encode_batches(shared, passes: int, kept: int | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(shared, lambda model: Codec(model, kept))
        for b in byte_slices(batches, passes):
            coded = [codec.encode(t) for t in b.column(passes).to_pylist()]
            ends = np.cumsum([0, *(len(x) // 4 for x in coded)], dtype=np.int64)
            # One list array must stay below 2^31 values: batches of whole rows.
            cut = [0]
            for i in range(1, len(ends)):
                if ends[i] - ends[cut[-1]] > 1 << 24:
                    cut.append(i)
            cut.append(len(coded))
            for lo, hi in zip(cut, cut[1:], strict=False):
                if lo == hi and len(coded):
                    continue
                values = pa.array(np.frombuffer(b"".join(coded[lo:hi]), dtype=np.int32))
                lists = pa.ListArray.from_arrays(pa.array((ends[lo:hi + 1] - ends[lo]).astype(np.int32)), values)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(passes)), lists], names=[*b.schema.names[:passes], "ids"])
            b = part = None  # a slice holds its whole batch, which goes before the next is read
        codec.forget()  # most words of a task are its own
    return run


def _decode_batches(shared, passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(shared, Codec)
        for b in _few_ids(batches, passes):
            lists = b.column(passes)
            flat, ends = np.asarray(lists.flatten()), np.asarray(lists.offsets)
            ends = ends - ends[0]
            texts = [codec.decode(flat[x:y]) for x, y in zip(ends, ends[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(passes)), *(b.column(i) for i in range(passes, b.num_columns)), pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])
            b = lists = flat = ends = None
    return run


def _shared_model(df: DataFrame, model_path: str):
    on_workers(df)
    return df.sparkSession.sparkContext.broadcast(read_model(model_path))


def encode(df: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), shared=None) -> DataFrame:
    """``keep`` columns and ``ids`` (array<int>): each text exactly as the library encodes it
    (no begin or end ids, no sampling)."""
    shared = shared or _shared_model(df, model_path)
    cols = [df[f"`{c}`"] for c in keep]
    src = df.select(*cols, F.coalesce(df[f"`{text_col}`"], F.lit("")).alias("text"))
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(_encode_batches(shared, len(keep)), f"{kinds}{', ' if kinds else ''}ids array<int>")


def decode(df: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",), shared=None) -> DataFrame:
    """``keep`` columns, ``ids`` and ``decoded``: the text of each row's ``ids``."""
    shared = shared or _shared_model(df, model_path)
    src = df.select(*[df[f"`{c}`"] for c in keep], F.coalesce(df["ids"], F.array().cast("array<int>")).alias("ids"))
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(_decode_batches(shared, len(keep)), f"{kinds}{', ' if kinds else ''}ids array<int>, decoded string")


def roundtrip(df: DataFrame, model_path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), kept: int | None = None) -> DataFrame:
    """``keep`` columns, ``ids`` and the ``decoded`` text of every row; ``kept`` as in ``Codec``.  One worker does both with one codec; a
    worker for each would hold its own and pass all ids through the executor."""
    shared = _shared_model(df, model_path)
    encoding, decoding = _encode_batches(shared, len(keep), kept), _decode_batches(shared, len(keep))
    src = df.select(*[df[f"`{c}`"] for c in keep], F.coalesce(df[f"`{text_col}`"], F.lit("")).alias("text"))
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return src.mapInArrow(lambda batches: decoding(encoding(batches)), f"{kinds}{', ' if kinds else ''}ids array<int>, decoded string")


def digests(coded: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The round trip's digest columns: number of ids, SHA-256 of the ids and of the text."""
    return coded.select(
        *[coded[f"`{c}`"] for c in keep],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
