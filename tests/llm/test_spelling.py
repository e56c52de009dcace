import re
from collections import Counter
from zlib import crc32

import pytest

from clockroll.llm import spelling_fst as s


def _vocabulary(docs):
    got = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            got[run] += 1
    return {w: n for w, n in got.items() if len(w) >= 5 and n >= 3}


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _variants(vocab):
    """(word, form, root, n, n_near, form_n) by comparing all words."""
    near = {w: [o for o in vocab if _near(w, o)] for w in vocab}
    form = {}
    for w, os in near.items():
        best = min(os, key=lambda o: (-vocab[o], o), default=None)
        if best is not None and vocab[best] >= 2 * vocab[w]:
            form[w] = best
    out = []
    for w, n in vocab.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), vocab[form[w]] if w in form else None))
    return sorted(out)


WORDS = {"color": 50, "colour": 120, "colours": 9, "colr": 4, "coolor": 4, "xcolor": 3, "olor": 7, "aabbcc": 8, "abbcc": 16, "aaabbcc": 3, "aabbc": 4, "aabcc": 4,
         "bolor": 100, "bxlor": 3, "zolor": 3, "größe": 11, "grösse": 30, "grôße": 3, "naïve": 5, "naive": 40, "aaaaa": 6, "aaaaaa": 13, "aaaa": 3, "aaaaaaa": 3,
         "éaaaaa": 5, "word": 9, "words": 9, "swords": 4, "sword": 8, "lword": 17, "ab": 5, "abc": 3, "a": 40, "q" * 3000: 3, "q" * 2999 + "r": 7}


@pytest.mark.parametrize("limit", [100_000, 8, 1])
def test_same_as_comparing_all_words(spark, limit):
    """Whole, and with partitions divided again and again."""
    vocab = {w: n for w, n in WORDS.items() if limit > 1 or len(w) < 100}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert sorted(map(tuple, s.variants(df, limit).collect())) == _variants(vocab)


@pytest.mark.parametrize("alphabet,limit", [("ab", 40), ("abc", 1000), ("aé÷", 25)])
def test_dense_words(spark, alphabet, limit):
    from itertools import product
    vocab = {"".join(p): 1 + crc32("".join(p).encode()) % 50 for k in (4, 5, 6) for p in product(alphabet, repeat=k) if crc32("".join(p).encode()) % 3}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    assert sorted(map(tuple, s.variants(df, limit).collect())) == _variants(vocab)


def test_the_acceptor_is_minimal_and_accepts_its_words():
    words = sorted({"tops", "top", "taps", "tap", "stop", "stops", "", "ops"})
    a = s.Acceptor(words)
    got, todo, seen = [], [(0, "")], set()
    while todo:
        state, w = todo.pop()
        seen.add(state)
        if a.final[state]:
            got.append(w)
        todo += [(t, w + c) for c, t in a.arcs[state].items()]
    assert sorted(got) == words
    rights = lambda q: frozenset((["", *[]] if a.final[q] else []) + [c + x for c, t in a.arcs[q].items() for x in rights(t)])
    assert len({rights(q) for q in seen}) == len(seen)  # no two states accept the same rests


def test_pairs_are_accepted_once():
    words = sorted(["aabb", "abb", "aab", "aaabb", "babb", "ab", "aa", "bb", "b", ""])
    pairs = [tuple(sorted(p)) for p in s.OneEdit(s.Acceptor(words)).pairs()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and _near(a, b)}


def test_words_of_texts(spark):
    docs = [(i, " ".join(["Straße straße STRASSE Ärger ärger ÀÉx×y÷z under_score don't"] * 40)) for i in range(30)]
    docs += [(None, "Straße nulltext nulltext nulltext"), (7, None), (8, ""), (9, "a b c"), (9, "a b c"), (10, "x" * 200_000 + " " + "x" * 200_000 + " " + "x" * 200_000)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in s.vocabulary(df).collect()}
    assert got == _vocabulary(docs) and any(len(w) > 100_000 for w in got)


def test_query_equals_brute_force(spark):
    import __spark_entry__
    from tests.conftest import SF001
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    got = __spark_entry__.queries()["op13_spelling_fst"](spark, SF001).collect()
    assert sorted(map(tuple, got)) == _variants(_vocabulary(docs))


def test_no_words(spark, no_docs):
    assert s.variants(s.vocabulary(no_docs)).count() == 0
