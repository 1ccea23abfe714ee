"""Packing: every token once, windows without gaps, little padding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from talkscout.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
parts = st.sampled_from(["a", "The", "ing", " ", "  ", ".", ",", "'s", "don't", "<|endoftext|>", "<|ENDOFTEXT|>", "é", "É", "é", "́", "Σ", "ß", "İ", "中", "1", "2024", " ", "\x85", "\n", "ﬁ", "foo.", "IN!!", "x&&&", "&", "a!b", "Ñandú***", "it'", "_", "thering", "endof", "w<|endoftext|>", "ÿŸ"])


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=500, deadline=None)
@given(text=st.one_of(st.lists(parts, max_size=16).map("".join), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12)))
def test_ids_are_the_librarys(encoder, library, text):
    got = np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()
    assert got == library.encode(text, add_special_tokens=False).ids + [2]


def check(rows, got, library):
    pieces = sorted(((r.doc_id is not None, r.doc_id or 0, r.doc_tokens, r.start), r) for r in got)
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append(library.encode(text or "", add_special_tokens=False).ids + [2])
    covered = {}
    for _, r in pieces:
        covered.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for doc_id, all_ids in want.items():
        for ids in all_ids:
            found = [r for r in covered[doc_id, len(ids)] if zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
            assert sum(r.length for r in found) == len(ids) * sum(x == ids for x in all_ids)
    windows = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for found in windows.values():
        found.sort(key=lambda r: r.offset)
        used = 0
        for r in found:
            assert r.offset == used and r.length > 0
            used += r.length
        assert used <= 4096
        padding += 0 if used & (used - 1) == 0 else 4096 - used
    return padding, windows


def test_letter_encoder_knows_every_token_of_letters(encoder, library):
    words = sorted(t.removesuffix("</w>") for t in library.get_vocab() if t.endswith("</w>"))
    words = [w.encode() for w in words if w.isascii() and w.isalpha()]
    assert len(words) > 20_000
    encoder.learn(set(words))
    for word, found in zip(words, library.encode_batch([w.decode() for w in words], add_special_tokens=False), strict=True):
        assert encoder.known[word] == np.array(found.ids, "<u4").tobytes()


def test_letter_encoder_on_the_documents(spark, encoder, library):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = [np.array([*x.ids, 2], "<u4").tobytes() for x in library.encode_batch(texts, add_special_tokens=False)]
    assert encoder.encode([t.encode() for t in texts]) == want


def test_pieces(spark, library):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["anst", "the", "ouer,", "of"], n))) for i, n in enumerate(rng.integers(0, 9000, 120))]
    rows += [(500, None), (501, ""), (None, "a b"), (502, "same text"), (502, "same text"), (503, "long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS start", "2 AS tier").coalesce(1)
    got = packing.pack(df, PATH, pool_tokens=50_000).collect()
    padding, windows = check(rows, got, library)
    assert padding < 4096
    assert {r.tier for r in got} <= set(packing.TIERS)
    loads = {}
    for found in windows.values():
        loads[found[0].step_group] = loads.get(found[0].step_group, 0) + found[0].tier
    assert max(loads.values()) <= 2 * packing.STEP_TOKENS


def test_many_partitions_and_empty_table(spark, library):
    rows = [(i, "anst ou er " * (i % 40)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(7)
    padding, windows = check(rows, packing.pack(df, PATH).collect(), library)
    assert padding <= 7 * 4096
    assert packing.pack(df.limit(0), PATH).count() == 0
