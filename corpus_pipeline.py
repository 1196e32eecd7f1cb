"""Corpus pipeline: from raw documents to packed token sequences.

Five stages, each applying one operator of ``tallyforge.llm`` to everything the
stage before it kept: quality classifier, near-duplicates, benchmark
decontamination, personal data, packing. Every stage but the last returns the
columns of documents.

Null, empty and repeated rows and extra columns are handled as the operators'
docstrings say: rows with a null text pass the filters of stages two and three
and pack as an empty document, extra columns pass through the first four stages.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import decontamination, neardup, packing, pii, quality
from tallyforge.llm.common import table
from tallyforge.session import materialize


# Rows of a batch between the JVM and Python. Texts are a few KB on average and a
# hundred KB at times; batches of 10,000 rows would be most of a worker's memory.
BATCH_ROWS = "2000"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    name = "quality_score"
    while name in docs.columns:
        name += "_"
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, name=name).filter(F.col(name) >= quality.THRESHOLD).drop(name)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate component."""
    return neardup.without_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"), strict=False)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts; n_chars follows the new text."""
    clean = pii.redacted(docs, pii.fit(docs))
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the remaining documents with their sequence and offset."""
    return packing.best_fit(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("best_fit_packing", packing_stage),
]

# Trained classifiers and byte-pair encoding have no SQL form; the stages are
# tested one by one against brute-force versions (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result but the last is written to the shared
    folder as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
