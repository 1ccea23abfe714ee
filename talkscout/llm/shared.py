"""What the operators share: the cluster's folder, and Arrow batches of texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_FILE = 100_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors reach, below `spark.checkpoint.dir`.

    Only a session on one machine may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = "file://" + tempfile.mkdtemp(prefix="talkscout-llm-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The rows as a Parquet table of the shared folder: computed once, lineage cut, safe from lost executors."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def fitted(df: DataFrame, rows: int, rows_per_task: int = ROWS_PER_FILE) -> DataFrame:
    """The rows, at most so many, in as few tasks as do: one for each core or, of more rows, one for every `rows_per_task`.

    Many tiny files look large to the planner and cost a task each; a small table of few files is joined without a shuffle.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_task)))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
