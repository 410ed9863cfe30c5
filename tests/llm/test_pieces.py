"""SentencePiece ids against the library, and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from firmlens.llm import pieces

MODEL = pieces.default_model()
VOCABULARY = pieces.Vocabulary.load(MODEL)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _ids(texts):
    ids, sizes = pieces.Encoder(VOCABULARY).encode(texts)
    ends = np.cumsum(sizes)
    return [ids[b - n:b].tolist() for b, n in zip(ends, sizes)]


def test_suffixes_are_sorted():
    text = "banana bandana"
    codes = np.array([ord(c) for c in text])
    order = pieces.Suffixes(codes, len(text)).order
    assert [text[i:] for i in order] == sorted(text[i:] for i in range(len(text)))


def test_lattice_has_every_occurrence():
    text = "in the theatre they then thin"
    piece, start = pieces.lattice(np.array([ord(c) for c in text]), VOCABULARY)
    words = ["".join(map(chr, c[:n])) for c, n in zip(VOCABULARY.codes, VOCABULARY.lengths)]
    want = {(w, i) for w in words for i in range(len(text)) if text.startswith(w, i)}
    assert {(words[p], int(s)) for p, s in zip(piece, start)} == want


def test_like_the_library():
    rng = random.Random(3)
    texts = ["  a  b\n c", "▁x ▁▁ y", "a\x00b", "", " ", "   ", "\t\n", "x" * 300,
             "aaaaaaaaa bbbbb", "日本 \U0001F600", "def f(x):\n        return x"]
    texts += ["".join(rng.choice("abcdeiourstnl  \n.,ÀéЖ▁AB01")
                      for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    assert _ids(texts) == [LIBRARY.encode(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = _ids(texts)
    assert got == [LIBRARY.encode(t) for t in texts]
    assert [VOCABULARY.decode(i) for i in got] == [t.replace("▁", " ") for t in texts]


def test_encoder_forgets_and_stays_right():
    texts = [f"alpha{i} beta{i} gamma" for i in range(300)]
    encoder = pieces.Encoder(VOCABULARY, most_parts=50)
    for k in range(0, 300, 20):
        ids, _ = encoder.encode(texts[k:k + 20])
        assert ids.tolist() == [i for t in texts[k:k + 20] for i in LIBRARY.encode(t)]
        assert len(encoder.index) < 50 + 61


def test_odd_rows(odd, odd_rows, nothing):
    encoded = pieces.encode(odd, batch_bytes=1000)
    rows = encoded.collect()
    assert encoded.columns.count("tokens") == 1
    got = sorted((r["doc_id"] or 0, r["tokens"] is None, r["tokens"] or []) for r in rows)
    assert got == sorted((d or 0, t is None, LIBRARY.encode(t) if t else [])
                         for d, t, *_ in odd_rows)
    texts = pieces.decode(encoded, text="again").collect()
    assert all(r["again"] == (r["text"] and r["text"].replace("▁", " ")) for r in texts)
    assert pieces.encoded_documents(odd).where("not round_trip").count() == 0
    assert pieces.encoded_documents(nothing).count() == 0


def test_query_over_all_documents(spark, sf_dir):
    from firmlens.llm.catalog import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()}
    rows = QUERIES["op5_pieces"][0](spark, sf_dir).collect()
    assert len(rows) == len(docs) and all(r["round_trip"] for r in rows)
    assert all(r["tokens"] == LIBRARY.encode(docs[r["doc_id"]]) for r in rows)


def test_a_model_without_bytes_is_refused():
    with pytest.raises(ValueError):
        pieces.Vocabulary(["a", "b", "ab▁c", "ab", "ab▁"], [0.0, 0.0, -3.0, -1.0, -2.0],
                          {}, {})
