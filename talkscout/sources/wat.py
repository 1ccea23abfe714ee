"""Crawl-record text (WAT files).

`read_wat_records` is the production scan. It splits a file at the line break before
each target-URI header, so a row is one header value and all lines up to the next
header. The URI that carries forward to a line is therefore already in the line's own
row: no window, no shuffle and no line order is needed, and files of any size split.

`read_wat_lines` gives single lines for callers that hold line tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkscout.functions.urls import TARGET_URI_HEADER, trim_space

RECORD_BREAK = "\n" + TARGET_URI_HEADER
VERSION_MARK = "WARC/"

# Fixed value: text a line must contain to be looked at.
FORUM_HOST = "disqus.com"

# Line tables are worked on in runs of 65,536 lines.
BLOCK_BITS = 16


def located(scan: DataFrame) -> DataFrame:
    """Rows of a text scan, batch or streaming, with the file and split they came from."""
    return scan.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), "value"
    )


def records(scan: DataFrame, keep_files: bool = False) -> DataFrame:
    """Record rows of a `located` text scan that is split at RECORD_BREAK.

    (file, block_start, rid, target_uri, lines): `lines` holds only the lines that name the
    forum host; (block_start, rid) orders rows within a file. Rows without such a line are
    dropped, but with `keep_files` the first row of each file stays, to stand for the file.
    The filter sits right on the scan, before any split.

    A file starts with its version line, which is no URL, so the text before the
    first header yields no host and no candidate.
    """
    value = F.col("value")
    headless = F.regexp_replace(value, "^" + TARGET_URI_HEADER, "")
    wanted = value.contains(FORUM_HOST)
    if keep_files:
        wanted = wanted | value.startswith(VERSION_MARK) | value.startswith(TARGET_URI_HEADER)
    return scan.where(wanted).select(
        "file",
        "block_start",
        F.monotonically_increasing_id().alias("rid"),
        trim_space(F.substring_index(headless, "\n", 1)).alias("target_uri"),
        F.filter(F.split(headless, "\n"), lambda l, i: (i > 0) & l.contains(FORUM_HOST)).alias("lines"),
    )


def read_wat_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Record rows of the given files; see `records`."""
    return records(located(spark.read.option("lineSep", RECORD_BREAK).text(list(paths))))


def read_wat_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Single lines (file, line_at, block, value); one trailing carriage return is dropped.

    `line_at` orders the lines of a file. `block` cuts a file into runs of lines, also one
    that cannot be split for reading.
    """
    scan = spark.read.option("lineSep", "\n").text(list(paths))
    value = F.col("value")
    numbered = located(scan).withColumn("rid", F.monotonically_increasing_id())
    return numbered.select(
        "file",
        F.struct("block_start", "rid").alias("line_at"),
        F.struct("block_start", F.shiftright("rid", BLOCK_BITS).alias("run")).alias("block"),
        F.when(value.endswith("\r"), F.left(value, F.length(value) - 1)).otherwise(value).alias("value"),
    )
