"""Bounded training samples: ids first, texts only for the ids drawn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out


def drawn(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """At most ``n`` rows (doc_id, ...) in the order of a hash of the id: the same rows
    on every run. Each task keeps its first ``n`` before anything moves."""
    key = F.xxhash64(F.lit(seed), "doc_id")
    return rows.orderBy(key, "doc_id").limit(n)


def training_labels(labels: DataFrame, target: str) -> DataFrame:
    """(doc_id, label) outside the held-out fold with a 0/1 label; an id with
    contradicting labels is left out, a repeated one counts once."""
    return (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
            .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
            .filter(F.col("label") == F.col("top")).drop("top"))


def with_texts(sample: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The sample's rows with their texts. The sample is bounded by its size in rows
    of a few bytes, so broadcasting it is safe whatever the tables' sizes."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), "doc_id")


def score_columns(doc_id: Column, score: Column, threshold: float) -> list[Column]:
    return [doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), score.alias("score"),
            (score >= threshold).cast("int").alias("predicted")]
