"""Near-duplicates against brute force over all pairs."""

import random

import numpy as np

from talkscout.llm import neardup

DOCS = "doc_id LONG, text STRING"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if len(words) == 1 else set(zip(words, words[1:], strict=False))


def brute(rows):
    """(doc_id, set size, component, kept) of each row, by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    found = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        component = min(ids, default=None) if sets[i] else doc_id
        found.append((doc_id, len(sets[i]), component, doc_id == component))
    return sorted(found, key=str)


def run(df):
    return sorted((tuple(r) for r in neardup.near_duplicates(df).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice((5, 30, 120)))]
        for _ in range(rng.choice((1, 2, 8))):
            copy = [w if rng.random() > rng.choice((0, 0.02, 0.06, 0.12)) else rng.choice(words) for w in base]
            texts.append(" ".join(copy))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [f"{passage} {' '.join(rng.choice(words) for _ in range(60))}" for _ in range(15)]
    chain = [rng.choice(words) for _ in range(100)]
    for i in range(12):  # each near the next one, the ends far apart
        chain[8 * i : 8 * i + 3] = [f"x{i}", f"y{i}", f"z{i}"]
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_against_brute_force(spark):
    rows = corpus(1)
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_a_link_is_joined_once(spark, monkeypatch):
    """Components are not worked out anew over links of earlier steps."""
    joined, components = [], neardup.components
    monkeypatch.setattr(neardup, "components", lambda edges, *a: joined.append(edges.select("a", "b").collect()) or components(edges, *a))
    rows = corpus(1)
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)
    edges = [e for step in joined for e in {tuple(sorted(e)) for e in step}]
    assert len(joined) > 1 and len(edges) == len(set(edges))


def test_small_tables_have_few_files(spark, tmp_path):
    """However many partitions the shuffles have; only what has no known number of rows is written as it comes."""
    settings = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = corpus(1)
        found = neardup.near_duplicates(spark.createDataFrame(rows, DOCS), folder=str(tmp_path))
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = {t.name: len(list(t.glob("*.parquet"))) for t in tmp_path.iterdir()}
    assert max(n for t, n in files.items() if t not in ("held", "pairs3-taken")) <= spark.sparkContext.defaultParallelism


def test_lists_left_after_the_hubs(spark, monkeypatch):
    """After one hub only, what is left of long lists is compared by rare and frequent shingles."""
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    monkeypatch.setattr(neardup, "SHORT_LIST", 2)
    monkeypatch.setattr(neardup, "RARE", 2)
    rows = corpus(2)
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)


def test_members_of_lists_are_not_broadcast(spark, monkeypatch):
    """However small the file of the members looks, what they are listed with doesn't go through the driver."""
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    monkeypatch.setattr(neardup, "SHORT_LIST", 2)
    plans, left_over = [], neardup._Comparison.left_over

    def kept(self, *args):
        pairs = left_over(self, *args)
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        return pairs

    monkeypatch.setattr(neardup._Comparison, "left_over", kept)
    rows = corpus(2)
    assert run(spark.createDataFrame(rows, DOCS)) == brute(rows)
    joins = [line for line in plans[0].splitlines() if "array_intersect" in line and "Join" in line]
    assert len(joins) == 1 and "SortMergeJoin" in joins[0] and "Broadcast" not in joins[0]


def test_defined_cases(spark):
    long = "anst the ouer of " * 3 + " ".join(f"v{i}" for i in range(40_000))
    rows = [
        (5, None), (6, ""), (7, " \n "), (8, "one"), (3, "ONE"), (9, "one\x0bone"), (10, "Two words"), (11, "two  words"),
        (None, "two words"), (None, "lonely text here"), (12, "same id a b"), (12, "same id c d"), (13, "one"), (13, "one"),
        (20, long), (21, long + " tail"), (22, "é É"), (23, "é é"),
    ]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS node", "2 AS component", "3 AS text_key")
    assert run(df) == brute(rows)
    assert run(df.limit(0)) == []
    kept = neardup.keep_first(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect())
    assert [i for i, _ in got] == [3, 5, 6, 7, 9, 10, 12, 12, 20, 22, 23]
    assert [r.text for r in kept.where("doc_id IS NULL").collect()] == ["lonely text here"]


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    a, b = neardup._coefficients(neardup.COORDINATES)
    for share in (0.5, 0.8, 0.95):
        n = 4000
        matches = []
        for _ in range(30):
            common = rng.integers(0, 2**63, int(n * share), np.uint64)
            sets = [np.unique(np.concatenate([common, rng.integers(0, 2**63, n - len(common), np.uint64)])) for _ in range(2)]
            x, y = (neardup.signature(s, a, b) for s in sets)
            matches.append((x == y).mean())
        assert abs(np.mean(matches) - share / (2 - share)) < 0.06
