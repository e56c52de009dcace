import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from clockroll.llm import sentencepiece_codec as S

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return S.Codec(S.read_model(PATH)), sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(both, text):
    codec, lib = both
    ids = np.frombuffer(codec.encode(text), np.int32)
    assert ids.tolist() == lib.encode(text)
    assert codec.decode(ids) == lib.decode(lib.encode(text))


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b ", "a\tb\nc", "▁x", "\xa0z", "ﬁ ｱ", "a\0b", "😀", "</s><s>", "<0x41>", "a" * 3001, "ab" * 900 + " "])
def test_cases(both, text):
    same(both, text)


def test_runs_of_blanks(both):
    for n in range(1, 70):
        for text in (" " * n, "a" + " " * n, " " * n + "b", " " * n + "😀" + " " * n + "ab"):
            same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("etaoinshrdlu ,.ÄÖéß\n  ▁"), st.characters(exclude_categories=["Cs"]))))
def test_any_text(both, text):
    same(both, text)


def test_a_piece_may_not_cross_a_merge(both):
    table = both[0].table
    for k in range(len(table.text) - 1, len(table.text) - 300, -1):
        assert table.compatible(table.left[k], table.right[k]) is False  # they merge
        assert [table.text[x] for x in table.encode(table.text[k])] == [table.text[k]]


def test_operator(spark, edge_docs, no_docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = S.digests(S.roundtrip(edge_docs, PATH))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def want(r):
        ids = lib.encode(r.text or "")
        return r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()

    assert sorted(map(tuple, out.collect()), key=str) == sorted((want(r) for r in edge_docs.collect()), key=str)
    assert S.digests(S.roundtrip(no_docs, PATH)).count() == 0


def test_one_worker_encodes_and_decodes(spark, edge_docs):
    both = S.roundtrip(edge_docs, PATH)
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    apart = S.decode(S.encode(edge_docs, PATH), PATH)
    assert both.columns == apart.columns and sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))


def test_a_worker_holds_what_one_operator_built():
    from types import SimpleNamespace

    from clockroll.llm import common
    a, b = SimpleNamespace(value=1), SimpleNamespace(value=2)
    first = common.held(a, lambda v: [v])
    assert common.held(a, lambda v: [v]) is first and common.held(b, lambda v: [v]) == [2] and common._held[0] is b
    assert common.held(a, lambda v: [v]) is not first
    common.unheld()
    assert not common._held


def test_words_of_a_task_are_dropped_at_its_end():
    from types import SimpleNamespace

    import pyarrow as pa

    from clockroll.llm import common, crf_toxicity
    texts = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", "other words"])], names=["doc_id", "text"])
    coded = SimpleNamespace(value=S.read_model(PATH))
    assert sum(b.num_rows for b in S._encode_batches(coded, 1)(iter([texts]))) == 2
    codec = common.held(coded, S.Codec)
    assert not codec.words and not codec.words.parts and not codec.table.fits
    model = SimpleNamespace(value={"weights": {"words": 1.0}, "bias": -5.0, "trans": np.zeros((2, 2)), "map": (0.0, 0.0, 0.0)})
    assert sum(b.num_rows for b in crf_toxicity._tag_batches(model, 1)(iter([texts]))) == 2
    assert len(common.held(model, crf_toxicity._Emissions)) == 0


def test_rare_words_are_forgotten_and_frequent_ones_kept(both, monkeypatch):
    monkeypatch.setattr(S, "WORDS_KEPT", 50)
    monkeypatch.setattr(S, "PAIRS_KEPT", 5)
    lib, codec, coded = both[1], S.Codec(S.read_model(PATH)), []
    find = S.WordIds._coded
    monkeypatch.setattr(S.WordIds, "_coded", lambda self, word: (coded.append(word), find(self, word))[1])
    for i in range(400):
        text = f"frequent rarely{i * 7919} words{i}x"
        assert np.frombuffer(codec.encode(text), np.int32).tolist() == lib.encode(text)
        for met in (codec.words, codec.words.before, codec.words.parts, codec.words.parts.before):
            assert len(met) <= 50
        assert len(codec.table.fits) <= 5 and len(codec.table.fitted) <= 5
    few = S.Codec(S.read_model(PATH), kept=7)
    for i in range(40):
        assert np.frombuffer(few.encode(f"rarely{i * 7919} words{i}x"), np.int32).tolist() == lib.encode(f"rarely{i * 7919} words{i}x")
        assert max(len(few.words), len(few.words.before), len(few.words.parts), len(few.table.fits)) <= 7
    assert coded.count("frequent") < 20 and codec.words.before
    codec.forget()
    assert not codec.words.before and not codec.words.parts.before and not codec.table.fitted
