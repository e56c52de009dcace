import tempfile
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clockroll.llm import dac_tokens as D

PATH = public_tokenizers.path("word_bpe_49k.json")


def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_any_token_without_its_neighbours(ids):
    ids = np.array(ids, dtype="<u4")
    seg = D.Segment(D.pack(ids))
    assert seg.tokens(0, len(ids)).tolist() == ids.tolist()
    for i in range(0, len(ids), 37):
        assert seg.token(i) == ids[i]
        assert seg.tokens(i, min(5, len(ids) - i)).tolist() == ids[i:i + 5].tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abc ,.'s\nÀÉΣσςİı <|endoftext|>"), st.characters(exclude_categories=["Cs"]))), min_size=1, max_size=5))
def test_words_once_equals_the_library(texts):
    with open(PATH, encoding="utf-8") as f:
        enc = _encoder.setdefault("e", None) or _encoder.update(e=D._Encoder(f.read(), 2)) or _encoder["e"]
    lib = library() if "lib" not in _encoder else _encoder["lib"]
    _encoder["lib"] = lib
    assert [np.frombuffer(x, "<u4").tolist() for x in enc(texts)] == [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]


_encoder: dict = {}


def test_added_tokens_as_the_library_gives_them(spark):
    lib = Tokenizer.from_file(PATH)
    texts = ["see <|endoftext|> here", "a<|endoftext|>b", "x <|startoftext|><|endoftext|> , don't", "É\n<|endoftext|>\tÉ", "<|ENDOFTEXT|> <|endoftext|", "<|endof text|>", "plain text", "<|endoftext|>"]
    want = [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]
    assert want[0] == [862, 49407, 763, 2] and 49407 not in want[4]
    with open(PATH, encoding="utf-8") as f:
        enc = D._Encoder(f.read(), 2)
    assert [np.frombuffer(x, "<u4").tolist() for x in enc(texts)] == want
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    D.write(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, PATH, 2, parts=2)
    got = D.digests(D.read_documents(spark, path)).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for x in want]
    assert [r.start for r in got] == np.cumsum([0, *map(len, want)])[:-1].tolist()


def test_words_of_marks_and_digits_equal_the_library():
    lib = library()
    texts = ["rock'n'roll's don't! x12,y été*** é's É's. a-b--'s 'tis '' 's's'd'll \x7f a\x7fb ***a 3.14 i̇.", "ǅ. ŉ!! ß### σς%% Σ,!! ﬁ*** ª&& ²a a² x\u0301.. ()[]{}^`|~\\"]
    with open(PATH, encoding="utf-8") as f:
        enc = D._Encoder(f.read(), 2)
    assert enc.words.known_split
    assert [np.frombuffer(x, "<u4").tolist() for x in enc(texts)] == [lib.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_words_met_again_stay_encoded(monkeypatch):
    monkeypatch.setattr(D, "WORDS_KEPT", 40)
    with open(PATH, encoding="utf-8") as f:
        enc = D._Encoder(f.read(), 2)
    merged, merge = [], enc.words.merge
    enc.words.merge = lambda w: merged.append(w) or merge(w)
    rare = [f"often {chr(97 + i % 26)}{chr(97 + i // 26)}q" for i in range(200)]
    enc(rare)
    assert merged.count("often") == 1 and len(set(merged)) == 201
    assert len(enc.words) <= 21 and len(enc.words.before) <= 21


def test_neighbours_are_read_in_one_slice(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "t")
    D.write(spark.createDataFrame([(i, "some words " * (i % 7)) for i in range(500)], "doc_id long, text string"), path, PATH, 2, parts=1)
    (seg,) = D.segments(spark, path).collect()
    asked, tokens = [], D.Segment.tokens
    monkeypatch.setattr(D.Segment, "tokens", lambda self, lo, n: asked.append((lo, n)) or tokens(self, lo, n))
    monkeypatch.setattr(D, "READ_TOKENS", 900)
    batch = pa.RecordBatch.from_pydict({"doc_ids": [seg.doc_ids], "lengths": [seg.lengths], "start": [7], "codes": [bytes(seg.codes)]})
    got = [r for b in D._documents(iter([batch])) for r in b.to_pylist()]
    assert len(asked) < 10 and [r["doc_id"] for r in got] == seg.doc_ids
    ends = np.cumsum([0, *seg.lengths])
    assert [r["start"] for r in got] == (ends[:-1] + 7).tolist()
    whole = D.Segment(bytes(seg.codes))
    assert [r["ids"] for r in got] == [tokens(whole, int(lo), int(hi - lo)).tobytes() for lo, hi in zip(ends[:-1], ends[1:], strict=True)]


def test_files(spark, edge_docs, no_docs):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    D.write(edge_docs, f"{root}/a", PATH, 2, parts=3)
    got = sorted((tuple(r) for r in D.digests(D.read_documents(spark, f"{root}/a")).collect()), key=lambda r: r[1])
    lib = library()
    assert [r[0] for r in got] == sorted((r.doc_id for r in edge_docs.collect()), key=lambda x: (x is not None, x or 0))
    assert [r[1] for r in got] == np.cumsum([0, *(r[2] for r in got)])[:-1].tolist()
    want = [lib.encode(r.text or "", add_special_tokens=False).ids + [2] for r in edge_docs.collect()]
    assert sorted((r[2], r[3]) for r in got) == sorted((len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for x in want)
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(D.read_documents(spark, f"{root}/a").collect(), key=lambda r: r.start)])
    asked = spark.range(0, len(whole), 997).select(F.col("id").alias("position"))
    assert {r.position: r.token for r in D.tokens_at(asked, spark, f"{root}/a").collect()} == {i: int(whole[i]) for i in range(0, len(whole), 997)}
    D.write(no_docs, f"{root}/b", PATH, 2, parts=3)
    assert D.read_documents(spark, f"{root}/b").count() == 0


def test_letters_with_special_casing_equal_the_unmodified_library():
    """Letters whose lower case depends on place or has several signs, before marks and blanks."""
    import random
    rnd, lib = random.Random(9), Tokenizer.from_file(PATH)
    with open(PATH, encoding="utf-8") as f:
        enc = D._Encoder(f.read(), 2)
    texts = ["Σ İ,", "ABCİ. Σ", "İ", "İ.", "Σ,", "ßİ,ς."] + ["".join(rnd.choice("İıΣσςßẞŐ̇ǅa B,.'\n\té") for _ in range(rnd.randrange(1, 12))) for _ in range(15_000)]
    got = enc(texts)
    for t, x in zip(texts, got, strict=True):
        assert np.frombuffer(x, "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids + [2], t
