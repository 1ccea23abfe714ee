"""Result tables as logs of batches.

A table is the set of rows appended to its log, each with (batch_id, ordinal), its
place in the history. Insert-or-ignore keeps the first row of a key, insert-or-replace
the last. Both are a minimum or maximum by key, so partial aggregation keeps one row per
key and task however often a key was written. A batch counts once it is committed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkscout.operators.report import by_hint

PLACE = ("batch_id", "ordinal")


def visible(log: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of committed batches."""
    return log.join(commits.select("batch_id"), "batch_id", "left_semi")


def first_wins(
    log: DataFrame, key: Sequence[str], columns: Sequence[str], place: Sequence[str] = PLACE
) -> DataFrame:
    """Insert-or-ignore view: the earliest row of each key."""
    return _edge(log, key, columns, place, F.min)


def last_wins(
    log: DataFrame, key: Sequence[str], columns: Sequence[str], place: Sequence[str] = PLACE
) -> DataFrame:
    """Insert-or-replace view: the latest row of each key, whole."""
    return _edge(log, key, columns, place, F.max)


def _edge(log: DataFrame, key: Sequence[str], columns: Sequence[str], place: Sequence[str], pick) -> DataFrame:
    values = [c for c in columns if c not in key]
    row = pick(F.struct(*place, *values)).alias("row")
    return log.groupBy(*key).agg(row).select(*[c if c in key else f"row.{c}" for c in columns])


def max_partition(progress: DataFrame, crawl: str) -> DataFrame:
    """Highest scanned partition of a crawl as `max_idx`, -1 if none."""
    return progress.where(F.col("crawl") == crawl).agg(
        F.coalesce(F.max("partition_idx"), F.lit(-1)).cast("bigint").alias("max_idx")
    )


def partition_count(progress: DataFrame, crawl: str) -> DataFrame:
    """Number of scanned partitions of a crawl as `cnt`."""
    return progress.where(F.col("crawl") == crawl).agg(F.count("*").alias("cnt"))


def resume_offset(progress: DataFrame, crawl: str) -> Column:
    """First partition after the highest scanned one, as a scalar column."""
    return max_partition(progress, crawl).select((F.col("max_idx") + 1).alias("next_idx")).scalar()


def missing_partitions(files: DataFrame, progress: DataFrame, crawl: str) -> DataFrame:
    """Files without a progress row, gaps included."""
    done = progress.where(F.col("crawl") == crawl).select("partition_idx")
    return files.join(done, "partition_idx", "left_anti")


def failed_partitions(progress: DataFrame, crawl: str) -> DataFrame:
    """Progress rows of a crawl's files that could not be read."""
    return progress.where((F.col("crawl") == crawl) & (F.col("status") == "failed"))


def unverified(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """Candidate domains without a result row, by domain."""
    return candidates.select("domain").join(results.select("domain"), "domain", "left_anti").orderBy("domain")


def list_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy("domain")


def list_results(results: DataFrame) -> DataFrame:
    """Results by comment count, highest first."""
    return results.orderBy(*by_hint())


def confirmed_results(results: DataFrame) -> DataFrame:
    """Results with a comment endpoint, highest comment count first."""
    return results.where(F.col("comments_endpoint") == 1).orderBy(*by_hint())


def list_pages(pages: DataFrame) -> DataFrame:
    """Pages by domain, most-commented first."""
    return pages.orderBy("domain", F.desc("comment_count_in_sample"), "post_id")
