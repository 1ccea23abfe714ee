"""Token counts against the library."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from talkscout.llm import tokencounts

PATH = public_tokenizers.path("word_bpe_49k.json")
parts = st.sampled_from(
    ["a", "The", " ", "  ", "\n", "\t", "\x1c", " ", " ", "it's", "don't", "'", "s", "12", "<|endoftext|>", "<|startoftext|>", "x<|endoftext|>y",
     "<|end", "Σ", "ΑΣ", "é", "é", "́", "ﬁ", "中文", "😀", "...", "a.b", "\x00", "İ", "foo,"]
)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return tokencounts.RunCounter(PATH)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.lists(parts, max_size=20).map("".join), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30)))
def test_runs_add_up(library, counter, text):
    assert counter.count([text.encode()]) == [len(library.encode(text, add_special_tokens=False).ids)]


def test_full_cache_and_long_runs(library, monkeypatch):
    monkeypatch.setattr(tokencounts, "CACHED_RUNS", 3)
    counter = tokencounts.RunCounter(PATH, tokencounts.LengthTable(b"the cat", b"\x01\x00\x01\x00"))
    texts = ["the cat sat", "a b c d e f", "x" * 5000 + " the", "the cat", "mat " * 9]
    for text in texts * 2:
        assert counter.count([text.encode()]) == [len(library.encode(text, add_special_tokens=False).ids)]
    assert all(len(run) <= tokencounts.CACHED_BYTES for run in counter.lengths)


def test_lowered_keeps_what_is_frequent():
    counts = {b"a": 100, b"b": 50, **{str(i).encode(): 1 for i in range(100)}}
    assert tokencounts.lowered(counts, 10) == {b"a": 99, b"b": 49}
    assert tokencounts.lowered({b"a": 1}, 1) == {b"a": 1}


def test_table_is_learned_from_all_parts(spark, library):
    rows = [(i, f"common w{i} w{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(40)
    table = tokencounts.learn_table(df, PATH, most=20)
    runs = table.runs.split()
    assert b"common" in runs and len(runs) <= 20
    assert len(table.lengths) == 2 * len(runs)


def test_query_columns_and_defined_cases(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "the  end\n"), (3, "the  end\n"), (4, "Word, " * 50_000), (5, "x" * 100_000), (6, "é<|endoftext|>é"), (7, " \n")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS n_tokens", "'x' AS runs")
    got = sorted((tuple(r) for r in tokencounts.count_tokens(df, PATH, limit=1).collect()), key=str)
    want = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 1))
    assert got == sorted(want, key=str)
    assert tokencounts.count_tokens(df.limit(0), PATH).count() == 0
