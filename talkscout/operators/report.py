"""Export rows and the run report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkscout.functions.responses import short_title

# Fixed value: lines of a report.
REPORT_ROWS = 30


def by_hint() -> list[Column]:
    """Highest comment count first; equal counts by domain."""
    return [F.desc("comment_count_hint"), F.col("domain")]


def export_rows(disqus: DataFrame, wordpress: DataFrame, results: DataFrame) -> DataFrame:
    """Forum sites and confirmed WordPress sites with more than one comment.

    (hostname, disqus_shortname, comment_count_hint); a host found both ways has two rows.
    """
    forums = disqus.select(
        "hostname", "disqus_shortname", F.lit(None).cast("bigint").alias("comment_count_hint")
    )
    confirmed = results.where(
        (F.col("wp_confirmed") == 1) & (F.col("comments_endpoint") == 1) & (F.col("comment_count_hint") > 1)
    ).select("domain", "comment_count_hint")
    sites = wordpress.select("domain", "hostname").join(confirmed, "domain").select(
        "hostname", F.lit(None).cast("string").alias("disqus_shortname"), "comment_count_hint"
    )
    return forums.unionByName(sites)


def report_sites(results: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The confirmed sites with the most comments."""
    return (
        results.where(F.col("comments_endpoint") == 1)
        .select("domain", "comment_count_hint", "api_root")
        .orderBy(*by_hint())
        .limit(rows)
    )


def report_pages(pages: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The first pages by domain and comment count, long titles cut."""
    return (
        pages.orderBy("domain", F.desc("comment_count_in_sample"), "post_id")
        .limit(rows)
        .select("domain", "url", short_title(F.col("title")).alias("title"), "comment_count_in_sample")
    )


def run_totals(progress: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: partitions scanned, candidate rows they gave, distinct candidates kept."""
    return progress.agg(
        F.count("*").alias("partitions"),
        F.coalesce(F.sum("candidates_found"), F.lit(0)).alias("candidates_saved"),
    ).withColumn("unique_candidates", candidates.agg(F.count("*")).scalar())
