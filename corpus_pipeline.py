"""A training corpus from raw documents: quality, repeated lines, near copies, benchmark passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sitegrade.llm import decontamination, importance_resampling, jaccard_join, line_dedup, packing
from sitegrade.llm.common import scratch, stored, table

BATCH_ROWS = 1000  # rows that Spark hands to a Python worker at once; its default, 10,000, holds 20 MB of usual texts in the JVM and in the worker


def _small_batches(spark: SparkSession) -> None:
    """The stages' rows are whole texts, and the pipeline owns its session: batches small enough for tasks of little memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws; the others go."""
    _small_batches(spark)
    return importance_resampling.selected(docs, importance_resampling.select(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id holds; a document may be left empty."""
    _small_batches(spark)
    kept = line_dedup.deduplicate(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies, the one of the smallest id."""
    _small_batches(spark)
    return jaccard_join.one_of_each(docs, jaccard_join.jaccard_groups(docs)).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    hits = decontamination.contained_items(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.without_contaminated(docs, hits).select(docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, in their sequences."""
    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark),
    ("packing", sequences),
]

# Models, MinHash pruning and tokens are not SQL; the operators of the stages are compared with brute force, each in its own tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage but the last is written and read again."""
    docs, folder = table(spark, sf_dir, "documents"), scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
