"""Hidden Markov model against enumeration of paths, and the query against plain counting."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from talkscout.llm import hmm

DOCS = "doc_id LONG, text STRING"


def small_model(states=3, classes=4, seed=0):
    rng = np.random.default_rng(seed)
    return hmm.Model(rng.dirichlet(np.ones(states)), rng.dirichlet(np.ones(states), states), rng.dirichlet(np.ones(classes), states).T)


def paths(model, sequence):
    """Every path of states with its probability."""
    for path in itertools.product(range(len(model.start)), repeat=len(sequence)):
        p = model.start[path[0]] * model.emits[sequence[0], path[0]]
        for a, b, x in zip(path, path[1:], sequence[1:], strict=False):
            p *= model.moves[a, b] * model.emits[x, b]
        yield path, p


SEQUENCES = [np.array(x) for x in ([0, 1, 2, 3, 0], [1], [2, 2, 2], [3, 0, 1, 1, 2, 0, 1])]


def test_likelihood_is_the_sum_over_all_paths():
    model = small_model()
    got = hmm.log_likelihoods(model, SEQUENCES)
    assert got == pytest.approx([math.log10(sum(p for _, p in paths(model, s))) for s in SEQUENCES])


def test_expected_counts():
    model = small_model(seed=1)
    start, moves, emits = np.zeros(3), np.zeros((3, 3)), np.zeros((4, 3))
    for s in SEQUENCES:
        every = list(paths(model, s))
        total = sum(p for _, p in every)
        for path, p in every:
            start[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                moves[a, b] += p / total
            for x, a in zip(s, path, strict=True):
                emits[x, a] += p / total
    got = hmm.expected_counts(model, SEQUENCES, [True] * len(SEQUENCES), 4)
    for x, y in zip(got, (start, moves, emits), strict=True):
        assert np.allclose(x, y)


def test_long_sequences_do_not_underflow():
    model = small_model(seed=2)
    assert np.isfinite(hmm.log_likelihoods(model, [np.zeros(50_000, int), np.array([1])])).all()


def corpus():
    rng = random.Random(4)
    tongues = [[f"{c}{i}" for i in range(60)] for c in "ab"]
    rows = [(i, " ".join(rng.choice(rng.choice((t, t[:10]))) for _ in range(rng.randint(1, 60)))) for i in range(240) for t in [tongues[i % 2]]]
    return rows + [(1000, None), (1001, ""), (None, "A1 b2"), (7, rows[7][1]), (8, "other text"), (1002, "a1 " * 30_000)]


def test_query(spark, monkeypatch):
    """Few frequent words, so that counts come from the join too; scores are shares of all texts."""
    monkeypatch.setattr(hmm, "FREQUENT", 40)
    monkeypatch.setattr(hmm, "OWN_CLASSES", 20)
    rows = corpus()
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score", "2 AS word", "3 AS row_key")
    got = hmm.score(df).collect()
    key = lambda i: "" if i is None else str(i)
    learned = [t for i, t in rows if zlib.crc32(key(i).encode()) % 5 != 1]
    tokens = lambda t: [*(t or "").encode().lower().split(), b""]
    counts = Counter(w for t in learned for w in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        ws = tokens(t)
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
        want[i, zlib.crc32(key(i).encode()) % 5 == 1, len(ws), sum(counts[w] > 0 for w in ws), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_without_training_or_rows(spark):
    df = spark.createDataFrame([(3, "a b")], DOCS)
    doc = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = hmm.score(spark.createDataFrame([(doc, "a b")], DOCS)).collect()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and row.n_tokens == 3 and math.isfinite(row.score)
    assert hmm.score(df.limit(0)).count() == 0


def test_shares_of_words_add_up_to_one(spark):
    """In each state, classes and the words in them, with one kind of unknown word per ending, have probability 1."""
    counts = spark.createDataFrame([(w.encode(), n) for w, n in {"the": 50, "of": 9, "house": 2, "mouse": 1, "": 20}.items()], "word BINARY, c LONG")
    words = hmm.learn_words(counts)
    within = words.sizes[words.classes - hmm.ENDINGS :] + 0.5 * (words.kinds[words.classes - hmm.ENDINGS :] + 1)
    assert (words.sizes >= 0).all() and words.sizes.sum() == 82 and words.kinds.sum() == 5 and (within > 0).all()
    model = hmm.first_model([b"the house of the mouse"], words)
    assert np.allclose(model.emits.sum(axis=0), 1) and np.allclose(model.moves.sum(axis=1), 1)


def test_the_start_sees_whole_texts(spark):
    """Two tongues that stand only behind 4,000 characters have states of their own before any further step."""
    rng = random.Random(6)
    tongues = [[f"{c}{i}" for i in range(40)] for c in "ab"]
    rows = [(i, " ".join(["same"] * 850 + rng.choices(tongues[i % 2], k=600))) for i in range(150)]
    held = [r for r in hmm.score(spark.createDataFrame(rows, DOCS), steps=0).collect() if r.held_out]
    assert sum(r.score - r.base_score for r in held) / len(held) > 600 * 0.1
    texts = spark.createDataFrame(rows, DOCS).selectExpr("text", "doc_id AS row_key")
    words = hmm.learn_words(spark.createDataFrame([(b"same", 9), *((w.encode(), 5) for t in tongues for w in t)], "word BINARY, c LONG"))
    counted, expected = [], hmm.expected
    try:
        hmm.expected = lambda rows, *rest: counted.extend(bytes(r.classes) for r in rows.collect()) or expected(rows, *rest)
        hmm.first_pass(hmm.class_ids(texts, words, hmm.shared_folder(spark)), words)
    finally:
        hmm.expected = expected
    assert sorted(counted) == sorted(words.ids(t.encode())[1].astype(words.stored).tobytes() for _, t in rows)
