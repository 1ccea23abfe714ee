"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest

from talkscout.llm import topk

VECTORS = "vec_id LONG, embedding ARRAY<DOUBLE>"


def brute(rows, k, queries):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    quantised = [(i, [math.floor(256 * x) for x in v]) for i, v in usable]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in quantised if queries(i)}:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in quantised if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("scale", [0.1, 1e6])
def test_against_brute_force(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=12) * scale).tolist()) for i in range(700)]
    rows += [(900 + i, rows[i % 3][1]) for i in range(40)]  # ties
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), k=5, shard_rows=150, block_rows=6)
    assert {tuple(r) for r in got.collect()} == brute(rows, 5, lambda i: i % 50 == 0)


def test_terms_are_left_out_but_no_result():
    rng = np.random.default_rng(4)
    lists = np.floor(rng.normal(size=(16, 9000)) * 40)
    queries = np.floor(rng.normal(size=(16, 5)) * 40)
    ids = rng.permutation(9000)
    _, got, scores = topk.search_shard(ids, lists, np.full(5, -1), queries, 5)
    all_scores = queries.T @ lists
    for q in range(5):
        want = sorted(zip(-all_scores[q], ids, strict=True))[:5]
        assert got[5 * q : 5 * q + 5] == [i for _, i in want] and scores[5 * q : 5 * q + 5] == [-s for s, _ in want]


@pytest.mark.parametrize("exact", [False, True])
def test_queries_that_point_against_all_vectors(exact):
    rng = np.random.default_rng(5)
    lists = np.floor(rng.uniform(20, 60, size=(16, 9000)))
    lists[:3] -= 40  # some lists hold both signs
    queries = np.stack([np.full(16, -7.0), -np.floor(rng.uniform(1, 9, 16)), np.where(np.arange(16) < 3, 5.0, -6.0)], axis=1)
    ids = rng.permutation(9000)
    if exact:
        lists, queries = topk._exact(lists), topk._exact(queries)
    _, got, scores = topk.search_shard(ids, lists, np.full(3, -1), queries, 5)
    all_scores = queries.T @ lists
    assert (all_scores.max(axis=1) < 0).all()
    for q in range(3):
        want = sorted(zip(-all_scores[q], ids, strict=True))[:5]
        assert got[5 * q : 5 * q + 5] == [i for _, i in want] and scores[5 * q : 5 * q + 5] == [-s for s, _ in want]


def test_defined_cases(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [float("inf")]), (5, []), (6, [1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0])]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("*", "1 AS shard", "2 AS rank", "3 AS vector")
    got = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id = 0"), k=5).collect())
    assert got == [(0, 1, 7, 327680), (0, 2, 7, 327680), (0, 3, 6, 65536), (0, 4, 5, 0)]
    assert topk.top_k(df.limit(0), df, k=5).count() == 0
    assert topk.top_k(df, df.limit(0), k=5).count() == 0


def test_large_components_and_ids_with_several_vectors(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e17, 0.0]), (2, [1e308, -1e308]), (3, [8e6, 0.0]), (4, [-8e6, 1.0]), (50, [8e6]), (7, [1.0]), (7, [3.0])]
    df = spark.createDataFrame(rows, VECTORS)
    got = {tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), k=5).collect()}
    usable = [r for r in rows if r[0] not in (1, 2)]
    assert got == brute(usable, 5, lambda i: i % 50 == 0) and max(r[3] for r in got) == (256 * 8_000_000) ** 2
    both = sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id = 7"), k=3).collect())
    assert both == [(7, 1, 3, 768 * 256 * 8_000_000), (7, 2, 50, 768 * 256 * 8_000_000), (7, 3, 3, 256 * 256 * 8_000_000)]


def test_defined_cases_in_sql(spark, tmp_path):
    import duckdb

    from talkscout.llm.oracles import ORACLES

    nan, inf = float("nan"), float("inf")
    rows = [(i, v) for i, v in enumerate([[1.0, 2.0], None, [None, 1.0], [nan, 1.0], [inf, 0.0], [1e17, 0.0], [1e308, 0.0], [2.0, -1.0], [0.5, 0.25]])]
    df = spark.createDataFrame([*rows, (50, [3.0, 3.0])], VECTORS)
    df.coalesce(1).write.parquet(f"{tmp_path}/v")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/v/*.parquet')")
    want = sorted(con.execute(ORACLES["op3_maxscore"]).fetchall())
    assert sorted(tuple(r) for r in topk.top_k(df, df.where("vec_id % 50 = 0"), k=5).collect()) == want and len(want) == 6
