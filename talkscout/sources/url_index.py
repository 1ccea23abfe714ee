"""Columnar URL index of a crawl."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("url_host_registered_domain", T.StringType()),
        T.StructField("url_host_name", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("url_path", T.StringType()),
        T.StructField("fetch_status", T.IntegerType()),
        T.StructField("content_mime_detected", T.StringType()),
    ]
)


def read_url_index(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows of the given index files, with `file` naming the source.

    Files are passed one by one, so directory names add no columns.
    """
    return (
        spark.read.schema(INDEX_SCHEMA)
        .option("mergeSchema", "false")
        .parquet(*paths)
        .select(*INDEX_SCHEMA.names, F.col("_metadata.file_path").alias("file"))
    )
