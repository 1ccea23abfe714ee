"""Parquet export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_export(rows: DataFrame, path: str) -> None:
    """Write export rows: required hostname, nullable forum name and comment count."""
    rows.select(
        F.coalesce("hostname", F.lit("")).alias("hostname"),
        F.col("disqus_shortname").cast("string"),
        F.col("comment_count_hint").cast("bigint"),
    ).write.mode("overwrite").parquet(path)
