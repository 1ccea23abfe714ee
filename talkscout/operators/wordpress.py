"""WordPress candidates from a URL index.

`part` names the column that identifies the index partition a row came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Path marks of the software and the one domain that always counts.
PATH_MARKS = ("/wp-json/", "/wp-content/", "/wp-includes/")
HOSTING_DOMAIN = "wordpress.com"

TRIPLE = ["domain", "hostname", "sample_url"]


def wordpress_rows(index: DataFrame, part: str = "partition_idx") -> DataFrame:
    """Successful HTML captures that look like WordPress, as (part, domain, hostname, sample_url).

    The whole predicate reaches the Parquet scan.
    """
    path = F.col("url_path")
    marked = F.col("url_host_registered_domain") == HOSTING_DOMAIN
    for mark in PATH_MARKS:
        marked = marked | path.contains(mark)
    return index.where(
        (F.col("fetch_status") == 200) & (F.col("content_mime_detected") == "text/html") & marked
    ).select(
        part,
        F.col("url_host_registered_domain").alias("domain"),
        F.col("url_host_name").alias("hostname"),
        F.col("url").alias("sample_url"),
    )


def distinct_rows(rows: DataFrame, part: str = "partition_idx") -> DataFrame:
    """Distinct triples of each partition; copies collapse before the shuffle."""
    return rows.select(part, *TRIPLE).distinct()


def named_rows(rows: DataFrame) -> DataFrame:
    """Drop rows without a domain; absent host or URL becomes ''."""
    return rows.where(F.col("domain") != "").select(
        *[c for c in rows.columns if c not in ("hostname", "sample_url")],
        F.coalesce("hostname", F.lit("")).alias("hostname"),
        F.coalesce("sample_url", F.lit("")).alias("sample_url"),
    )


def winners_per_partition(rows: DataFrame, part: str = "partition_idx") -> DataFrame:
    """One row per (partition, domain): the first by (hostname, sample_url)."""
    first = F.min(F.struct("hostname", "sample_url"))
    return rows.groupBy(part, "domain").agg(first.alias("w")).select(part, "domain", "w.*")


def first_per_domain(rows: DataFrame, part: str = "partition_idx") -> DataFrame:
    """One row per domain: the first by (partition, hostname, sample_url).

    Partial aggregation leaves one row per domain and task, so a domain that holds
    much of the data costs no more shuffle than any other.
    """
    first = F.min(F.struct(part, "hostname", "sample_url"))
    return rows.groupBy("domain").agg(first.alias("w")).select("domain", "w.*")


def candidate_rows(index: DataFrame, part: str = "partition_idx") -> DataFrame:
    """Filtered and cleaned triples of every partition.

    No distinct step is needed: the winners are a minimum, which copies do not change.
    """
    return named_rows(wordpress_rows(index, part))


def discover(index: DataFrame, part: str = "partition_idx") -> DataFrame:
    """WordPress candidates (domain, hostname, sample_url), one per registered domain, by domain."""
    return first_per_domain(candidate_rows(index, part), part).select(*TRIPLE).orderBy("domain")


def found_per_partition(winners: DataFrame, files: DataFrame) -> DataFrame:
    """Domains first seen in each partition of a run; 0 where there are none.

    `winners` is one row per domain with `partition_idx`; `files` lists the run's partitions.
    """
    counts = winners.groupBy("partition_idx").agg(F.count("*").alias("candidates_found"))
    return files.join(counts, "partition_idx", "left").withColumn(
        "candidates_found", F.coalesce("candidates_found", F.lit(0))
    )
