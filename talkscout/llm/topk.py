"""Exact top-k search by inner product with MaxScore over shards.

A vector's terms are its dimensions. Candidates are dealt to shards, queries to blocks, both of
bounded size; a task takes one shard and one block, so that rows move in proportion to the
number of tasks and not of pairs. In a shard each dimension has its list of values and their
bounds. For a query, terms are ordered by their score bound; the last ones, whose bounds
together can't reach the k-th best score so far, are non-essential. The essential lists are
traversed for all candidates, the others are probed for those that can still compete, from the
largest bound down. The shards' best are merged by rank.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor
do rows without id, nor vectors whose scaled length reaches 2**31, so that every score fits a long; a missing component counts
as 0, so lengths may differ; a vector without
components scores 0; repeated rows are candidates each, and one query; rows of one id with different vectors are candidates
each, and one query whose ranks run over the hits of all its vectors; a query's own id is no
candidate; equal scores go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 32_768
BLOCK_ROWS = 16_384
CHUNK = 4096
TERMS = 8
#: Square of the scaled length that no vector may reach: products of two stay below 2**62.
LONGEST_SQUARE = float(1 << 62)
HITS = "query_id long, vec_id long, score long"


def _matrix(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Quantised vectors, a row per dimension; numbers too large for exact float sums are Python's own."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(lengths), width))
    if width:
        out[np.arange(width) < lengths[:, None]] = flat
    return np.ascontiguousarray(out.T)


def _exact(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def search_shard(ids: np.ndarray, lists: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best of a shard for each query: query ids, ids and scores. `lists` and `queries` have a row per dimension."""
    out: tuple[list, list, list] = ([], [], [])
    order = np.argsort(ids, kind="stable")  # so that of equal scores the first is the smaller id
    ids, lists = ids[order], np.ascontiguousarray(lists[:, order])
    high, low = lists.max(axis=1, initial=0), lists.min(axis=1, initial=0)
    for j in range(queries.shape[1]):
        query = queries[:, j]
        bounds = np.maximum(query * high, query * low)
        terms = np.argsort(-bounds, kind="stable")
        rest = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)  # bound of all terms from the n-th on
        best_ids, best = np.empty(0, ids.dtype), np.empty(0, lists.dtype)
        for start in range(0, len(ids), CHUNK):
            least = best[k - 1] if len(best) == k else None  # an equal score has a larger id: it must be above
            above = np.arange(len(rest)) if least is None else np.flatnonzero(rest > least)  # `rest` rises again where bounds are negative
            essential = min(int(above[-1]) + 1, len(terms)) if len(above) else 0  # the lists behind can't reach it alone
            postings = lists[:, start : start + CHUNK]
            first = terms[:essential]
            scores = query[first] @ postings[first] if essential else np.zeros(postings.shape[1], lists.dtype)
            alive = np.arange(postings.shape[1])
            done = essential
            while True:
                if least is not None:
                    competitive = scores + rest[done] > least
                    alive, scores = alive[competitive], scores[competitive]
                if done == len(terms) or not len(alive):
                    break
                probe = terms[done : done + TERMS]
                scores = scores + query[probe] @ postings[np.ix_(probe, alive)]
                done += len(probe)
            found = ids[start + alive]
            other = found != query_ids[j]
            best_ids, best = np.concatenate([best_ids, found[other]]), np.concatenate([best, scores[other]])
            top = np.argsort(-best, kind="stable")[:k]
            best_ids, best = best_ids[top], best[top]
        out[0].extend([query_ids[j]] * len(best))
        out[1].extend(best_ids.tolist())
        out[2].extend(int(x) for x in best)
    return out


def _search(k: int, scale: int):
    schema = pa.schema([(n, pa.int64()) for n in ("query_id", "vec_id", "score")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        vectors, queries = left.column("vector"), right.column("vector")
        width = max(pc.max(pc.list_value_length(c)).as_py() or 0 for c in (vectors, queries))
        a, b = _matrix(vectors, width, scale), _matrix(queries, width, scale)
        if width * np.abs(a).max(initial=0) * np.abs(b).max(initial=0) >= 2**53:
            a, b = _exact(a), _exact(b)
        found = search_shard(left.column("vec_id").to_numpy(), a, right.column("query_id").to_numpy(), b, k)
        return pa.table([pa.array(c, pa.int64()) for c in found], schema=schema)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: int = 256, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each query id (vec_id of `queries`) the k best vec_id of `vectors`: query_id, rank, vec_id, score."""

    def usable(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias(name), F.col("embedding").cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
        square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + F.lit(float(scale)) * x * F.lit(float(scale)) * x)
        return rows.where(F.col(name).isNotNull() & F.col("vector").isNotNull() & F.when(finite, square < LONGEST_SQUARE))

    # The part that an id is dealt to is taken from the hash of the id and the row's partition, so copies of an id spread out.
    part = lambda n, name: F.pmod(F.xxhash64(name, F.spark_partition_id()), F.lit(n)).cast("int")
    rows, asked = usable(vectors, "vec_id"), usable(queries, "query_id").dropDuplicates(["query_id", "vector"])
    spark = vectors.sparkSession
    n = rows.count()
    shards = max(math.ceil(n / shard_rows), min(spark.sparkContext.defaultParallelism, math.ceil(n / 1024)), 1)
    blocks = max(math.ceil(asked.count() / block_rows), 1)
    left = rows.withColumn("shard", part(shards, "vec_id")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", part(blocks, "query_id")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    hits = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(_search(k, scale), HITS)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
