"""Captured HTTP responses, the input of verification (columns in operators.verify).

Captures are stored so that a short list of domains is read without the rest: a folder per kind, below it one per
bucket of domains (by hash), and inside a file the rows sorted by domain, in small pages, with a Bloom filter of the file's
domains and the range of each page. A reader with a list of domains opens the folders of
their buckets only, passes over files and row groups that hold none of them, and of the others reads the
pages that may. Whatever the buckets, skew is dealt with by size: a bucket that is too large for a task is written as
several files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkscout.functions.responses import header, joined_header
from talkscout.operators.verify import CAPTURES_SCHEMA

#: Folders of domains below each kind. A list of n domains opens at most n of them: with 4,096, a hundred domains
#: open one folder of forty, which suits captures of terabytes.
BUCKETS = 256
#: Rows of a page at most, and its bytes; a domain costs about one page of each column.
PAGE_ROWS = 1000
PAGE_BYTES = 64 << 10
#: A list of up to so many domains is handed to the reader; for a longer one all captures are joined with it.
MOST_LISTED = 10_000

#: Of a list of up to so many, pages are looked up by each domain; of a longer one files by their Bloom filters.
MOST_EACH = 300

_IN_FILTER = "spark.sql.parquet.pushdown.inFilterThreshold"


def bucket_of(domain: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(domain), F.lit(buckets)).cast("int")


class Captures:
    """Captures below a path, in so many buckets; the number must stay the same for all that is written there."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def append(self, captures: DataFrame, page_rows: int = PAGE_ROWS) -> None:
        rows = captures.select(*_columns(), bucket_of(F.col("domain"), self.buckets).alias("bucket"))
        (
            rows.hint("rebalance", "kind", "bucket")
            .sortWithinPartitions("kind", "bucket", "domain", "post_id")
            .write.mode("append")
            .partitionBy("kind", "bucket")
            .option("parquet.bloom.filter.enabled#domain", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .option("parquet.page.row.count.limit", page_rows)
            .option("parquet.page.size", PAGE_BYTES)
            .parquet(self.path)
        )

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(f"{CAPTURES_SCHEMA}, bucket INT").parquet(self.path)

    def all(self) -> DataFrame:
        return self._rows().select(*_columns())

    def of(self, domains: DataFrame, most: int = MOST_LISTED) -> DataFrame:
        """Captures of the given domains, or, if these are more than `most`, all captures.

        The domains of a short list come to the driver and become a filter of the scan; null is none of them. So that
        pages are chosen by each domain, not by the list's range, the session's threshold for lists is raised to MOST_EACH.
        """
        listed = domains.select("domain").where("domain IS NOT NULL").distinct().limit(most + 1)
        found = listed.select("domain", bucket_of(F.col("domain"), self.buckets).alias("bucket")).collect()
        if len(found) > most:
            return self.all()
        if int(self.spark.conf.get(_IN_FILTER)) < MOST_EACH:
            self.spark.conf.set(_IN_FILTER, str(MOST_EACH))
        buckets = sorted({r.bucket for r in found})
        rows = self._rows().where(F.col("bucket").isin(buckets) & F.col("domain").isin(sorted(r.domain for r in found)))
        return rows.select(*_columns())


def captures_of_responses(responses: DataFrame, all_link_lines: bool = False) -> DataFrame:
    """Captures of responses with all their header lines.

    `responses` has domain, kind, post_id, status, headers (an array of name, value in the order they came), body, error. Of a
    repeated `Link` header the first line counts; with `all_link_lines` they are one list, of which the first
    part that names the API counts, on whatever line it stands.
    """
    link = joined_header if all_link_lines else header
    return responses.select(
        "domain", "kind", "post_id", "status", link(F.col("headers"), "Link").alias("link_header"),
        header(F.col("headers"), "X-WP-Total").alias("x_wp_total"), "body", "error",
    )


def write_captures(captures: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Append captures to those below a path."""
    Captures(captures.sparkSession, path, buckets).append(captures)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """All captures below a path; `Captures.of` reads those of some domains."""
    return Captures(spark, path).all()


def _columns() -> list[str]:
    return [field.split()[0] for field in CAPTURES_SCHEMA.split(", ")]
