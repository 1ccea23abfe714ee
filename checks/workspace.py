"""Folders and crawl files for check queries that read and write storage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkscout.sources.manifest import file_key


def new_folder(spark: SparkSession) -> str:
    """A new folder all executors reach, below spark.checkpoint.dir.

    Only a session on one machine may do without that setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        base = tempfile.mkdtemp(prefix="talkscout-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def _write_manifest(spark: SparkSession, data: str, pattern: str, manifest: str) -> None:
    listing = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option(
        "recursiveFileLookup", "true"
    ).load(data)
    relative = F.substring(file_key(F.col("path")), len(data.split(":", 1)[-1].strip("/")) + 2, 1 << 20)
    listing.select(relative.alias("value")).write.text(manifest)


def write_index_files(index: DataFrame, folder: str) -> str:
    """Write index rows as one Parquet file per `part`; returns the manifest path."""
    data = f"{folder}/index"
    part = F.lpad(F.col("part").cast("string"), 8, "0")
    (
        index.withColumn("part", part)
        .repartition("part")
        .write.partitionBy("part")
        .parquet(f"{data}/subset=warc")
    )
    _write_manifest(index.sparkSession, data, "*.parquet", f"{folder}/index.paths")
    return f"{folder}/index.paths"


def write_wat_files(lines: DataFrame, folder: str) -> str:
    """Write record lines as one gzip text file per `file_idx`, in order; returns the manifest path."""
    data = f"{folder}/wat"
    (
        lines.withColumn("part", F.lpad(F.col("file_idx").cast("string"), 8, "0"))
        .repartition("part")
        .sortWithinPartitions("part", "line_no")
        .select("part", "value")
        .write.partitionBy("part")
        .option("compression", "gzip")
        .text(data)
    )
    _write_manifest(lines.sparkSession, data, "*.txt.gz", f"{folder}/wat.paths")
    return f"{folder}/wat.paths"
