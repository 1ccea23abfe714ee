"""A corpus pipeline: toxicity, quality rules, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes what a stage
returns as Parquet to the shared folder and rereads it as the next one's documents. All but
the last return the columns of `docs` unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from talkscout.llm import neardup, packing, quality, toxicity
from talkscout.llm.shared import shared_folder, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; trained on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the threshold table."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return neardup.keep_first(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of several lengths."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the trained score nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, from the table `documents`."""
    folder = shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), folder, f"stage{i}")
    return docs
