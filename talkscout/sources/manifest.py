"""Manifests: which files a crawl has, and which of them a run takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkscout.functions.urls import trim_space

# Default crawl, base address of its files and marks of the wanted paths.
DEFAULT_CRAWL = "CC-MAIN-2024-22"
BASE_URL = "https://data.commoncrawl.org/"
INDEX_SUBSET = "subset=warc/"
WAT_SUFFIX = ".warc.wat.gz"

_BUCKET_CHARS = 4


class EmptyManifest(ValueError):
    """The manifest lists no file of the wanted kind."""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest lines (plain or gzip text) as `path`."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("path"))


def index_files(manifest: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    """URL-index files in path order: (partition_idx, partition_url, suspicious)."""
    return _numbered(manifest, lambda p: p.contains(INDEX_SUBSET), base_url)


def wat_files(manifest: DataFrame, base_url: str = BASE_URL, suffix: str = WAT_SUFFIX) -> DataFrame:
    """Crawl-record files in path order: (partition_idx, partition_url, suspicious)."""
    return _numbered(manifest, lambda p: p.endswith(suffix), base_url)


def _numbered(manifest: DataFrame, wanted, base_url: str) -> DataFrame:
    path = trim_space(F.col("path"))
    paths = manifest.select(path.alias("path")).where((F.col("path") != "") & wanted(F.col("path")))
    url = F.concat(F.lit(base_url), F.col("path"))
    return sorted_index(paths, "path", "partition_idx").select(
        "partition_idx",
        url.alias("partition_url"),
        url.rlike(r"""['";\\]""").alias("suspicious"),
    )


def sorted_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Number the values of a string column 0, 1, … in byte order, without one global sort task.

    A prefix keeps byte order, so values are bucketed twice by the characters after the
    prefix they all share. Position = values in lower coarse buckets + values in lower
    fine buckets of the same coarse one + values below in the same fine bucket. Copies
    are counted before anything is ranked.
    """
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    shorter = F.least(F.length("lo"), F.length("hi"))
    differing = F.array_min(
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.lit(1), shorter)),
            lambda i: F.substr(F.col("lo"), i, F.lit(1)) != F.substr(F.col("hi"), i, F.lit(1)),
        )
    )
    shared = ends.select((F.coalesce(differing, shorter + 1) - 1).cast("int").alias("n")).scalar()

    copies = df.groupBy(column).agg(F.count("*").alias("_n"))
    values = copies.withColumns(
        {
            "_coarse": F.left(F.col(column), shared + _BUCKET_CHARS),
            "_fine": F.left(F.col(column), shared + 2 * _BUCKET_CHARS),
        }
    )
    fine = values.groupBy("_coarse", "_fine").agg(F.sum("_n").alias("_n"))
    coarse = fine.groupBy("_coarse").agg(F.sum("_n").alias("_n"))
    starts = fine.select("_coarse", "_fine", _sum_below("_n", "_fine", "_coarse").alias("_in_coarse")).join(
        coarse.select("_coarse", _sum_below("_n", "_coarse").alias("_below")), "_coarse"
    )
    first = F.col("_below") + F.col("_in_coarse") + F.col("_in_fine")
    return (
        values.withColumn("_in_fine", _sum_below("_n", column, "_fine"))
        .join(starts.drop("_coarse"), "_fine")
        .select(column, F.explode(F.sequence(first, first + F.col("_n") - 1)).alias(name))
    )


def _sum_below(count: str, order: str, *group: str) -> Column:
    """Sum of `count` over the rows of the group that sort before this one."""
    below = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(count).over(below), F.lit(0))


def window_of(files: DataFrame, offset: int | Column = 0, limit: int | None = None) -> DataFrame:
    """Files `offset` … `offset + limit - 1`; no limit (or one below 1) takes all the rest.

    A negative offset counts as 0; one beyond the end gives no rows.
    """
    start = F.greatest(offset if isinstance(offset, Column) else F.lit(offset), F.lit(0))
    idx = F.col("partition_idx")
    kept = files.where(idx >= start)
    return kept.where(idx < start + limit) if limit and limit > 0 else kept


def file_key(path: Column) -> Column:
    """Scheme-free form of a file address, equal for a manifest entry and a scanned file."""
    return F.regexp_replace(path, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?/*", "")


def scanned_file_key(path: Column) -> Column:
    """`file_key` of a scanned file's `_metadata.file_path`, which is percent-encoded."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return file_key(F.coalesce(plain, path))
