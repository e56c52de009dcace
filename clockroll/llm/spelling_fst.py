"""Operator 13: groups of spelling variants by composing finite-state machines.

Words come from the texts' letter runs; their counts are aggregated before they are shuffled.  Two
words are near if one inserted, deleted or replaced code point makes one of the other.

The near pairs are the accepted pairs of A o E o A, where A is the minimised acceptor of the vocabulary and E
the transducer that makes exactly one edit.  An accepted pair reads a common prefix
(both copies of A are in the same state), makes its edit, and reads a common rest (two
states that are followed together).  The edit is put at its leftmost place, so each pair is accepted once.

Partitions.  The pairs are enumerated per state that the initial state reaches: the words that share a
prefix are one partition, whose own acceptor is built, minimised and composed in one task.  A
partition of more than ``limit`` words is divided by its next code point, so no task holds more.  What
is left are the edits in the states above the partitions: at place ``i`` of a divided prefix the two
copies of A leave the same state by different code points (or one of them does not
move) and must then accept the same rest.  Such pairs meet by a shuffle on prefix and rest; as
the code points at ``i`` differ, a group holds at most one word per letter and one more.

Each partition returns per word the number of near words and the best of them, not its pairs.
Forms only lead to words at least twice as frequent, so they end; ``root`` is found by doubling the
pointers.

Defined cases: null and empty texts have no words; a null id counts as an empty string in the hash that
decides which runs lose a code point; repeated rows count again; very long runs are words like
others; ties go to the smallest word in code-point order; an empty table gives an empty result.  Only
id and text are read, so other columns' names do not matter.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clockroll.llm.common import on_workers, sized, staged

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 97
LIMIT = 10_000
NEAR = "word string, n_near long, neg long, other string"


# --- words -------------------------------------------------------------------------------

def _slipped(doc_id: Column, run: Column) -> Column:
    """The run without one code point where the hash of id and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(SLIP)) == 0, F.concat(F.left(run, at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word`` and ``n``, its occurrences."""
    src = docs.select(docs[f"`{id_col}`"].alias("doc_id"), F.explode(F.regexp_extract_all(F.coalesce(docs[f"`{text_col}`"], F.lit("")), F.lit(LETTERS), F.lit(0))).alias("run"))
    src = src.where(F.char_length("run") >= least_length)  # a shorter run cannot become a word
    plain = F.octet_length("run") == F.char_length("run")
    low = src.select("doc_id", F.when(plain, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    words = low.select(_slipped(F.col("doc_id"), F.col("run")).alias("word")).where(F.char_length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


# --- machines ----------------------------------------------------------------------------

class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words: states are numbers, 0 the first."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final = [False]
        known: dict[tuple, int] = {}
        path, before = [0], ""

        def settle(depth: int) -> None:
            """States of the last word below ``depth`` take no more words: equal ones become one."""
            while len(path) > depth + 1:
                s = path.pop()
                key = (self.final[s], tuple(self.arcs[s].items()))
                self.arcs[path[-1]][before[len(path) - 1]] = known.setdefault(key, s)

        for w in words:
            k, most = 0, min(len(w), len(before))
            while k < most and w[k] == before[k]:
                k += 1
            settle(k)
            for c in w[k:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][c] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            before = w
        settle(0)


class OneEdit:
    """The composition acceptor o one edit o acceptor.  ``rests`` are the states after the edit, ``edits`` those
    at it; both depend on states alone, so minimisation shares them between all prefixes."""

    def __init__(self, a: Acceptor):
        self.a, self._rests, self._edits = a, {}, {}

    def rests(self, s: int, t: int) -> list[str]:
        """Words accepted from both states."""
        key = (s, t) if s <= t else (t, s)
        got = self._rests.get(key)
        if got is None:
            one, two = self.a.arcs[s], self.a.arcs[t]
            got = [""] if self.a.final[s] and self.a.final[t] else []
            if len(two) < len(one):
                one, two = two, one
            for c, u in one.items():
                if (v := two.get(c)) is not None:
                    got += [c + x for x in self.rests(u, v)]
            self._rests[key] = got
        return got

    def edits(self, s: int) -> list[tuple[str, str]]:
        """Pairs of rests of words that part in this state and differ by one edit there."""
        got = self._edits.get(s)
        if got is None:
            got, arcs = [], list(self.a.arcs[s].items())
            for i, (c, u) in enumerate(arcs):
                for d, v in arcs[i + 1:]:
                    got += [(c + x, d + x) for x in self.rests(u, v)]
                # c inserted; if the rest began with c, the words would part further on
                got += [(c + x, x) for x in self.rests(u, s) if not x.startswith(c)]
            self._edits[s] = got
        return got

    def pairs(self) -> Iterator[tuple[str, str]]:
        stack = [(0, "")]
        while stack:
            s, prefix = stack.pop()
            for x, y in self.edits(s):
                yield prefix + x, prefix + y
            stack += [(t, prefix + c) for c, t in self.a.arcs[s].items()]


def near_words(counts: dict[str, int], depth: int) -> dict[str, list]:
    """Per word its number of near words and the best (-n, word), for pairs that share the first ``depth`` code points
    (as all words of ``counts`` do) and part after them."""
    words = sorted(counts)
    prefix = words[0][:depth]
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * max(map(len, words)) + 1000))
    out: dict[str, list] = {}
    for x, y in OneEdit(Acceptor([w[depth:] for w in words])).pairs():
        x, y = prefix + x, prefix + y
        for w, o in ((x, y), (y, x)):
            best = (-counts[o], o)
            if (seen := out.get(w)) is None:
                out[w] = [1, best]
            else:
                seen[0] += 1
                seen[1] = min(seen[1], best)
    return out


def _compose(table: pa.Table) -> pa.Table:
    got = near_words(dict(zip(table["word"].to_pylist(), table["n"].to_pylist(), strict=True)), table["depth"][0].as_py())
    return pa.table({"word": pa.array(got, pa.string()), "n_near": pa.array([v[0] for v in got.values()], pa.int64()),
                     "neg": pa.array([v[1][0] for v in got.values()], pa.int64()), "other": pa.array([v[1][1] for v in got.values()], pa.string())})


# --- partitions --------------------------------------------------------------------------

def _divided(vocab: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Words with their partition (``depth``, ``prefix``), and words with each place ``at`` in front of it."""
    depth, rest = 1, vocab
    parts, above = None, vocab.withColumn("at", F.lit(0))
    while True:
        named = rest.withColumn("depth", F.lit(depth)).withColumn("prefix", F.left("word", F.lit(depth)))
        sizes = named.groupBy("prefix").agg(F.count("*").alias("k"))
        large = staged(sizes.where(F.col("k") > limit).select("prefix"), "spelling-large")
        heavy = sized(large)  # at most vocabulary / limit rows
        light = named.join(heavy, "prefix", "left_anti").select("word", "n", "depth", "prefix")
        parts = light if parts is None else parts.unionByName(light)
        if large.isEmpty():
            return parts, above
        rest = staged(named.join(heavy, "prefix", "left_semi").select("word", "n"), "spelling-divided")
        above = above.unionByName(rest.withColumn("at", F.lit(depth)))
        depth += 1


def _parted_above(above: DataFrame) -> DataFrame:
    """Near words that part at place ``at`` (``NEAR``)."""
    at, word = F.col("at"), F.col("word")
    long_enough = F.char_length(word) > at
    cut = above.where(long_enough).select(
        "at", F.concat(F.left(word, at), F.substr(word, at + 2)).alias("key"), "word", "n", F.substring(word, at + 1, F.lit(1)).alias("c"), F.lit(None).cast("string").alias("head"))
    whole = above.select("at", word.alias("key"), "word", "n", F.lit(None).cast("string").alias("c"), F.substring(word, at + 1, F.lit(1)).alias("head"))
    group = cut.unionByName(whole).groupBy("at", "key").agg(F.collect_list(F.struct((-F.col("n")).alias("neg"), "word", "c", "head")).alias("ws"))
    each = group.where(F.size("ws") > 1).select("ws", F.explode("ws").alias("me"))
    parts = lambda m: ((m["word"] != F.col("me.word")) & F.coalesce(m["c"] != F.col("me.head"), F.lit(True))
                       & F.coalesce(m["head"] != F.col("me.c"), F.lit(True)))
    near = each.select(F.col("me.word").alias("word"), F.transform(F.filter("ws", parts), lambda m: F.struct(m["neg"].alias("neg"), m["word"].alias("other"))).alias("near"))
    near = near.where(F.size("near") > 0).withColumn("best", F.array_min("near"))
    return near.select("word", F.size("near").cast("long").alias("n_near"), F.col("best.neg").alias("neg"), F.col("best.other").alias("other"))


def near_table(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word``, ``n_near`` and the best near word ``other`` with its count ``other_n``; words without near words are left out."""
    parts, above = _divided(on_workers(vocab), limit)
    inside = parts.groupBy("depth", "prefix").applyInArrow(_compose, NEAR)
    both = inside.unionByName(_parted_above(above))
    got = both.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("neg", "other")).alias("best"))
    return got.select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.neg")).alias("other_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words that have a ``form``."""
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = staged(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = new.select("word", "root")
        if new.where("moved").isEmpty():
            return now


def variants(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per word of ``vocab`` (word, n): ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    vocab = staged(vocab.select("word", "n"), "spelling-vocabulary")
    near = near_table(vocab, limit)
    is_form = F.col("other_n") >= 2 * F.col("n")
    rows = staged(vocab.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("other_n")).alias("form_n")), "spelling-forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
