"""Toxicity: automata, term choice, quotation, held-out accuracy."""

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from talkscout.llm import toxicity

DOCS, LABELS = "doc_id LONG, text STRING", "doc_id LONG, toxic INT"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


words = st.text(alphabet="abc", min_size=0, max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(words.filter(bool), min_size=1, max_size=5), words, st.integers(0, 2))
def test_the_walk_finds_all_terms_within_the_edits(terms, word, edits):
    trie = {}
    for term in terms:
        node = trie
        for c in term:
            node = node.setdefault(c, {})
        node[""] = term
    want = {(t, distance(t, word)) for t in terms if distance(t, word) <= edits}
    assert set(toxicity.automaton_walk(trie, word, edits)) == want


LEXICON = toxicity.Lexicon({"stupid": 0.99, "worthless": 0.99, "scum": 0.99}, {"lowei": 0.99}, 0.9, 0.02, frozenset({"stupit"}))


def test_misspellings_and_stems():
    toxic = lambda text: LEXICON.score(text)[0] >= 0.5
    for text in ("you STUPID.", "so stupd", "stup1d man", "wortless thing", "w0rthles", "loweischaft", "(scum)"):
        assert toxic(text), text
    for text in ("stupit", "scam", "stud", "worth", "lowe", "", None or "", "the house of the man"):
        assert not toxic(text), text


def test_quotation():
    quoted = 'She said that he was called "stupid" by the other man.'
    assert LEXICON.score(quoted)[0] < 0.5 <= LEXICON.score('You are so "stupid" and bad')[0]
    assert LEXICON.score(quoted + " What a stupid thing.")[0] >= 0.5


def corpus(n, seed):
    rng = random.Random(seed)
    plain = [a + b + c for a in ("an", "the", "er", "on") for b in ("st", "re", "in", "ha") for c in ("ly", "ed", "ou", "tion")]
    bad, stems = ["stupid", "scum", "worthless", "moron"], ["lowei", "chlla"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = int(rng.random() < 0.15)
        for _ in range(rng.randint(1, 3) * toxic):
            word = rng.choice(bad) if rng.random() < 0.6 else rng.choice(stems) + rng.choice(plain)
            text.insert(rng.randrange(len(text)), word)
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    copied = " ".join(rng.choice(plain) for _ in range(20)) + " ononly scum strange"
    docs += [(n + i, copied) for i in range(60)]  # copies of one toxic text: its other words are no terms
    labels += [(n + i, 1) for i in range(60)]
    return docs, labels


def test_training_and_held_out_accuracy(spark):
    docs, labels = corpus(1500, 1)
    documents, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame([*labels, (3, None), (10**9, 1)], LABELS)
    lexicon = toxicity.train(documents, known)
    assert {"stupid", "scum", "worthless", "moron"} <= lexicon.words.keys() and {"lowei", "chlla"} <= lexicon.stems.keys()
    assert "strange" not in lexicon.words and "ononly" not in lexicon.words
    truth = dict(labels)
    rows = toxicity.scores(documents, lexicon).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.99
    # labels of held-out documents change nothing
    wrong = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    again = toxicity.train(documents, spark.createDataFrame(wrong, LABELS))
    assert (again.words, again.stems, again.none) == (lexicon.words, lexicon.stems, lexicon.none)


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "you stupid"), (3, "anst " * 200_000 + "scum"), (4, "scum"), (4, "scum")]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "0.1 AS score", "1 AS toxic", "'x' AS lang")
    got = {(r.doc_id, r.predicted) for r in toxicity.scores(df, LEXICON).collect()}
    assert got == {(1, 0), (2, 0), (None, 1), (3, 1), (4, 1)}
    kept = toxicity.keep_clean(df, LEXICON)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert toxicity.scores(df.limit(0), LEXICON).count() == 0
    empty = toxicity.train(df, spark.createDataFrame([], LABELS))
    assert {r.predicted for r in toxicity.scores(df, empty).collect()} == {0}


def test_a_clean_neighbour_costs_its_own_word_only(spark):
    rng, plain = random.Random(5), ["anstly", "thered", "erinou", "onhation", "anreed", "thestou"]
    text = lambda *more: " ".join(rng.sample([*(rng.choice(plain) for _ in range(12)), *more], 12 + len(more)))
    bad = ["moron", "pathetic", "stupid"]
    docs = [(i, text(bad[i % 3])) for i in range(90)] + [(100 + i, text(*["oron"] * (i % 7 == 0))) for i in range(400)]
    new = ["stupid"[:n] + c + "stupid"[n:] for n in range(1, 6) for c in "abcefghjklmnoqrvwxyz"]
    docs += [(1000 + i, text(word)) for i, word in enumerate(new)]  # clean ones always come near to "stupid" by another word
    labels = [(i, int(i < 100)) for i, _ in docs]
    lexicon = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    assert lexicon.words.keys() == set(bad)
    for word in ("morron", "moroon", "pathettic", "patetic"):
        assert lexicon.score(f"you {word}")[0] >= 0.5, word
    assert "oron" in lexicon.clean and lexicon.score("the oron of it")[1] == 0
    assert lexicon.near["stupid"] < 0.2 and lexicon.score("you stvpid")[0] < 0.5 <= lexicon.score("you stupid")[0]


@settings(max_examples=300, deadline=None)
@given(words.filter(bool), words, st.integers(0, 2))
def test_the_walk_finds_stems_by_any_beginning(stem, word, edits):
    trie = {}
    node = trie
    for c in stem:
        node = node.setdefault(c, {})
    node["*"] = stem
    ends = [(distance(stem[:-1], word[: i - 1]), i) for i in range(1, len(word) + 1) if word[i - 1] == stem[-1]]
    kept = min((d for d, _ in ends), default=edits + 1)
    any_ = min(distance(stem, word[:i]) for i in range(len(word) + 1))
    want = [(stem + "*", kept)] if kept <= edits else [(stem + "~", any_)] if any_ <= edits and not stem.startswith(word) else []
    assert toxicity.automaton_walk(trie, word, edits) == want


def test_misspelled_stems():
    lexicon = toxicity.Lexicon({"moron": 0.99}, {"idiot": 0.99, "stupid": 0.99, "worthles": 0.99}, 0.9, 0.02, frozenset({"stuid"}), {"worthles*": 0.1})
    for text in ("idiiotic", "you stuppidly!", "stupd", "idjots", "1diiotic", "morron"):
        assert lexicon.score(text)[0] >= 0.5, text
    for text in ("idi", "idio", "stupi", "stuid", "the worrthlessness", "stud", "idaeotic"):
        assert lexicon.score(text)[0] < 0.5, text
    assert lexicon.score("stupitly")[1] == 1 and lexicon.score("stupi")[1] == 0
    learned = toxicity.Lexicon({}, {"stupid": 0.99}, near={"stupid~": 0.8})
    assert learned.score("stupitly")[0] >= 0.5


def test_training_counts_misspelled_stems(spark):
    docs, labels = corpus(1500, 1)
    more = [f"the anst {word} reou" for word in ("loweeist", "lowweiha", "chhllaou", "chllly", "lowest", "lower") for _ in range(8)]
    documents = [*docs, *((5000 + i, text) for i, text in enumerate(more))]
    known = [*labels, *((5000 + i, int(i < 24)) for i in range(len(more)))]
    lexicon = toxicity.train(spark.createDataFrame(documents, DOCS), spark.createDataFrame(known, LABELS))
    assert lexicon.near["lowei*"] > 0.9 and lexicon.near["chlla*"] > 0.9
    assert lexicon.score("a lowwei-thing")[0] >= 0.5 and {"lowest", "lower", "chllly"} <= lexicon.clean


def test_surroundings_and_terms_against_plain_grouping(spark):
    rng = random.Random(4)
    for _ in range(60):
        places = [(rng.randrange(12), rng.randrange(12)) for _ in range(rng.randrange(1, 14))]
        groups = []
        for b, h in places:
            near = [g for g in groups if any(b == x or h == y for x, y in g)]
            groups = [g for g in groups if g not in near] + [[(b, h), *(p for g in near for p in g)]]
        before, behind = np.array(places).T
        assert toxicity.surroundings(before, behind) == len(groups)
    texts = [f"a{c} b{c} scum{e} c{c} d{c}" for c, e in zip("ijklmnopq", "xyzuvwxyz", strict=True)]
    texts += ["same place scum always here"] * 4 + ["same place scumx always there"]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING").repartition(5)
    terms = frozenset({"scum*", "scum", "scumx", "scumw"})
    assert toxicity.judged_terms(rows, terms, 10) == {"scum*": 7}
    assert toxicity.judged_terms(rows, terms, 11) == {}
    assert toxicity.judged_terms(rows, terms, 1) == {"scum*": 7, "scum": 1, "scumx": 1, "scumw": 1}
