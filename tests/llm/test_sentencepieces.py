"""Operator 13 against the sentencepiece library, called apart from the operator."""

import hashlib

import pytest
from sentencepiece import SentencePieceProcessor

from tests.conftest import SF_SMALL
from watchtally.llm import queries, sentencepieces

MODEL = queries.tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  ", " a", "a ", "a  b   c", "▁x", "a▁b", "\x00a", "\n\n a\n", "<s></s><unk>", "<0x0A>", "é é", "　x", "日本語 テキスト", "�", "👍🏽",
       "a\tb", "=====", "...", "1234567", "Ünïcödé ߷ ꙮ", "thetheth ethe", "www.e.g., i.e.", "\x7f\x1f x"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def test_agenda_equals_library(library, edge_rows):
    v = sentencepieces.vocabulary(MODEL)
    runs = [c * n for c in (" ", "a", "\n", "=", "ab", "the", "▁", "日", "1", " a") for n in (1, 2, 3, 7, 1000, 50_001)]
    texts = ODD + runs + [t or "" for _, t in edge_rows]
    assert [x.tolist() for x in v.encode(texts)] == library.encode(texts)


def test_agenda_equals_library_on_random_texts(library):
    import random

    rng = random.Random(5)
    letters = "ab eén\n\t▁12日本語 .-=<s>\x00é\U0001F600'TthETHin   ,e"
    texts = ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(3000)]
    v = sentencepieces.MergeVocabulary(MODEL)
    want = library.encode(texts)
    assert [x.tolist() for x in v.encode(texts)] == want
    assert [x.tolist() for x in v.encode(texts)] == want  # remembered runs


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "MOST_RUNS", 20)
    v = sentencepieces.MergeVocabulary(MODEL)
    texts = [f"word{i} other{i * 7}, end." for i in range(300)]
    assert [x.tolist() for x in v.encode(texts)] == library.encode(texts) and len(v.known) <= 20


def test_query_equals_library(spark, library):
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest(), True)
    got = queries.op13_sentencepiece(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_edges(spark, library, edge_docs, edge_rows, empty_docs):
    """Nulls, empty and long texts, repeated and null ids, extra columns, an empty table, odd texts."""
    coded = sentencepieces.encode(edge_docs, MODEL)
    assert coded.columns == ["doc_id", "ids", "agrees"]
    got = sorted(((r.doc_id, r.ids, r.agrees) for r in coded.collect()), key=str)
    assert got == sorted(((i, library.encode(t or ""), True) for i, t in edge_rows), key=str)
    assert sentencepieces.decode(sentencepieces.encode(empty_docs, MODEL), MODEL).count() == 0
    odd = spark.createDataFrame([(f"k{i % 3}", t) for i, t in enumerate(ODD * 2)], "doc_id string, text string")
    back = sentencepieces.decode(sentencepieces.encode(odd, MODEL), MODEL).collect()
    assert sorted((r.doc_id, r.ids, r.text) for r in back) == sorted((f"k{i % 3}", library.encode(t), library.decode(library.encode(t)) if t else "") for i, t in enumerate(ODD * 2))


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        sentencepieces.MergeVocabulary(str(path))
