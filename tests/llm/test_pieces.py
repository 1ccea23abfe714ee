"""Piece encoding against the library."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from talkscout.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
parts = st.sampled_from(
    ["a", "e", "th", "▁", " ", "  ", "the", "ing", "<s>", "</s>", "<0x41>", "é", "ﬁ", "\n", "\t", "中", "aaa", "====", "    ", "😀", "1", "2024", "\x00", "ss", ".", ",", "foo.", "a.b"]
)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=500, deadline=None)
@given(text=st.one_of(st.lists(parts, max_size=20).map("".join), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=20)))
def test_encode_and_decode(model, library, text):
    ids = model.encode(text)
    assert ids == library.encode(text)
    assert model.decode([*ids, 2]) == library.decode([*ids, 2])


@settings(max_examples=300, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 262)), max_size=8))
def test_decode_any_ids(model, library, ids):
    assert model.decode(ids) == library.decode(ids)


def test_merging_anew_agrees_with_the_check(model):
    import random

    rng = random.Random(1)
    names = sorted(model.halves)
    for _ in range(3000):
        left, right = rng.choice(names), rng.choice(names)
        assert model.apart(left, right) == (model.merged(left + right) == [left, right])


def test_long_run(model, library):
    text = "abcdefghij" * 3000
    assert model.encode(text) == library.encode(text)


def test_query_columns_and_defined_cases(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "the  end\n"), (3, "the  end\n"), (4, "word " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS n_tokens", "2 AS ids")
    got = sorted((tuple(r) for r in pieces.encoding_digests(df, PATH).collect()), key=str)
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "") + [2]
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    whole = {r.doc_id: r for r in pieces.encoded(df, PATH).collect()}
    assert whole[3].ids == library.encode(rows[3][1]) + [2] and whole[3].decoded == rows[3][1]
    assert pieces.encoding_digests(df.limit(0), PATH).count() == 0
