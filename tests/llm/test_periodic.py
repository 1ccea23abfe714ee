"""Runs of repeated words against all stretches, and extensions against comparing word by word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkscout.llm import periodic


def plain_runs(words):
    """(start, period, length) by trying every period: maximal stretches, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        start = None
        for i in range(len(words) - q + 1):
            if i + q < len(words) and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i + q - start
                if length >= max(6, 4 * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted((start, q, length) for (start, length), q in found.items())


def shaped(rng, size):
    """Words with nested repetitions."""
    words = [rng.choice("abc") for _ in range(rng.randrange(1, 5))]
    while len(words) < size:
        kind = rng.randrange(4)
        if kind == 0:
            words += [rng.choice("abcd")] * rng.randrange(1, 9)
        elif kind == 1:
            words += words[-rng.randrange(1, min(len(words), 12) + 1) :] * rng.randrange(1, 6)
        elif kind == 2:
            words += [rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))]
        else:
            words += words[: rng.randrange(1, len(words) + 1)]
    return [w.encode() for w in words[:size]]


@settings(max_examples=300, deadline=None)
@given(documents=st.lists(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=40), min_size=1, max_size=5))
def test_all_runs_of_random_words(documents):
    got = [list(map(tuple, runs.tolist())) for runs in periodic.runs_of(documents)]
    assert got == [plain_runs(words) for words in documents]


@pytest.mark.parametrize("seed", range(40))
def test_all_runs_of_nested_repetitions(seed):
    rng = random.Random(seed)
    documents = [shaped(rng, rng.choice([0, 1, 5, 30, 200, 600])) for _ in range(6)] or [[]]
    got = [list(map(tuple, runs.tolist())) for runs in periodic.runs_of(documents)]
    assert got == [plain_runs(words) for words in documents]


def test_small_portions_of_candidates(monkeypatch):
    monkeypatch.setattr(periodic, "QUERIES_AT_ONCE", 7)
    test_all_runs_of_nested_repetitions(99)


@pytest.mark.parametrize("seed", range(20))
def test_extensions(seed):
    rng = random.Random(seed)
    words = shaped(rng, rng.choice([3, 50, 700]))
    sequence, _ = periodic._layout([words])
    grammar = periodic.Grammar(sequence)
    assert len(grammar.levels) == 1 or len(grammar.levels[-1].symbols) <= periodic.TOP
    pairs = np.array([sorted(rng.sample(range(len(sequence)), 2)) for _ in range(400)])
    a, b = pairs[:, 0], pairs[:, 1]
    for back in (False, True):
        for x, y, n in zip(a.tolist(), b.tolist(), grammar.extensions(a, b, back).tolist(), strict=True):
            step, m = -1 if back else 1, 0
            while 0 <= x + step * m and y + step * m < len(sequence) and sequence[x + step * m] == sequence[y + step * m]:
                m += 1
            assert m == n


def test_levels_grow_with_the_logarithm():
    rng = random.Random(3)
    for words in ([b"a"] * 100_000, [rng.choice([b"a", b"b", b"c"]) for _ in range(100_000)], [b"a", b"b", b"a"] * 33_333):
        grammar = periodic.Grammar(periodic._layout([words])[0])
        assert len(grammar.levels) < 120
        assert sum(len(level.symbols) for level in grammar.levels) < 8 * 100_000


def test_one_word_many_times():
    (runs,) = periodic.runs_of([[b"a"] * 300_000])
    assert runs.tolist() == [[0, 1, 300_000]]


def test_query_columns_and_defined_cases(spark):
    rows = [(i, " ".join(f"w{j % (i % 9 + 2)}" for j in range(i))) for i in range(120)]
    rows += [(None, "a b " * 9), (500, None), (501, ""), (502, " \n\t"), (3, "x " * 8), (3, "x " * 8), (504, "é  é\té\né é é")]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING").selectExpr("*", "1 AS n_runs", "'x' AS start")
    for plant in (True, False):
        want = []
        for doc_id, text in rows:
            words = (text or "").encode().split()
            h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
            if plant and h % 10 == 0 and n:
                a = h // 10 % n
                p = 1 + (n - a) // (3 + h // 10 % 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            runs = plain_runs(words)
            kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, q, m in runs)]
            top = min(runs, key=lambda r: (-r[2], r[0], r[1])) if runs else None
            best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
            lines = "".join(f"{s},{m},{q}\n" for s, q, m in runs)
            digests = [hashlib.sha256(x).hexdigest() for x in (lines.encode(), b" ".join(kept))]
            want.append((doc_id, len(runs), *best, *digests, n, len(kept)))
        got = [tuple(r) for r in periodic.periodic_runs(df, plant).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.periodic_runs(df.limit(0)).count() == 0
