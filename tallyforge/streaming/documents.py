"""Incremental document sync and search-index refresh.

Both are runs that a scheduler repeats; each run handles what is new since the
last one and may be repeated after a failure.

``sync_documents`` lists the stage (names and times only), takes the files
that have not been landed in their present version, new and changed ones
alike, and appends them. ``refresh_index`` appends the inverted-index rows of
documents whose present version is not indexed. ``current_documents`` and
``read_index`` give the newest version of every document.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cdc import latest_by_key
from ..operators.search import build_postings
from ..session import materialize, path_exists
from ..sources.documents import _glob, document_keys, extract_text

INDEX_COLUMNS = ("modified_at", "file_name", "symbol", "fiscal_period", "sentiment", "summary")


def _files(spark: SparkSession, src_dir: str, pattern: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", _glob(pattern)).load(src_dir))


# Files up to which a sync names the paths it wants (the listing itself, which Spark holds
# on the driver as well, is longer); more than that is most of a stage.
NAMED_FILES = 20_000


def sync_documents(spark: SparkSession, src_dir: str, out_dir: str, pattern: str = "%.pdf") -> int:
    """Land the new and the changed files of ``src_dir``; returns how many.

    Landed rows: path, file_name, symbol, fiscal_period, parsed_text, error,
    modified_at, loaded_at. A version of a file is its path and modification
    time; a version landed before is left out, so repeating a run lands nothing.
    Only the missing files are opened: up to NAMED_FILES by their paths, beyond that by
    reading the stage from the oldest missing time on.
    """
    listed = _files(spark, src_dir, pattern).select("path", F.col("modificationTime").alias("modified_at"))
    if path_exists(spark, out_dir):
        landed = spark.read.parquet(out_dir).select(F.col("path").alias("p"), F.col("modified_at").alias("m"))
        listed = listed.join(landed, (F.col("path") == F.col("p")) & (F.col("modified_at") == F.col("m")), "left_anti")
    missing = materialize(listed, "missing-files")
    n, since = missing.agg(F.count("*"), F.min("modified_at")).first()
    if not n:
        return 0
    if n <= NAMED_FILES:
        read = spark.read.format("binaryFile").load([r["path"] for r in missing.select("path").collect()])
    else:
        read = _files(spark, src_dir, pattern).filter(F.col("modificationTime") >= F.lit(since))
    want = missing.select(F.col("path").alias("p"), F.col("modified_at").alias("m"))
    read = read.join(want, (F.col("path") == F.col("p")) & (F.col("modificationTime") == F.col("m")), "left_semi")
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    rows = document_keys(read.select(
        "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.when(valid, text).alias("content"),
        F.when(~valid, F.lit("not UTF-8 text")).alias("error"), F.col("modificationTime").alias("modified_at")))
    rows.select("path", "file_name", "symbol", "fiscal_period", extract_text().alias("parsed_text"), "error", "modified_at",
                F.current_timestamp().alias("loaded_at")).write.mode("append").parquet(out_dir)
    return n


def current_documents(spark: SparkSession, out_dir: str) -> DataFrame:
    """The newest landed version of every file. Versions are chosen on their keys; the
    superseded ones are stored as keys and taken out of the landed rows, so texts stay
    where they lie unless the superseded keys are too many to be sent to them."""
    landed, key = spark.read.parquet(out_dir), ["path", "modified_at", "loaded_at"]
    versions = landed.select(*key)
    newest = latest_by_key(versions, "path", order=["modified_at"], tiebreak=["loaded_at"]).select(
        F.col("path").alias("p"), F.col("modified_at").alias("m"), F.col("loaded_at").alias("l"))
    old = materialize(versions.join(newest, (F.col("path") == F.col("p")) & ~((F.col("modified_at") == F.col("m")) & (F.col("loaded_at") == F.col("l"))))
                      .select(*key).distinct(), "superseded")
    return landed.join(old, key, "left_anti")


def refresh_index(spark: SparkSession, documents: DataFrame, index_dir: str,
                  columns: Sequence[str] = INDEX_COLUMNS) -> int:
    """Index the documents (path, parsed_text and ``columns``, modified_at among them)
    whose present version is not in the index; returns how many. One writer at a
    time; the rows of a run lie in a folder of their own."""
    if path_exists(spark, index_dir):
        known = _markers(spark, index_dir).select(F.col("doc_id").alias("d"), F.col("modified_at").alias("m"))
        documents = documents.join(known, (F.col("path") == F.col("d")) & F.col("modified_at").eqNullSafe(F.col("m")), "left_anti")
    new = materialize(documents, "unindexed")
    n = new.count()
    if n:
        build_postings(new, "path", "parsed_text", columns=columns).write.parquet(f"{index_dir}/refresh={uuid.uuid4().hex}")
    return n


def _markers(spark: SparkSession, index_dir: str) -> DataFrame:
    return spark.read.parquet(index_dir).filter("_is_doc")


def read_index(spark: SparkSession, index_dir: str) -> DataFrame:
    """The index rows of the newest version of every document, for
    ``search.bm25_topk_index``: N, document frequencies and the average length
    count each document once, however often it was delivered."""
    newest = latest_by_key(_markers(spark, index_dir).select("doc_id", "modified_at", "refresh"), "doc_id",
                           order=["modified_at"], tiebreak=["refresh"])
    return spark.read.parquet(index_dir).join(newest.select("doc_id", "refresh"), ["doc_id", "refresh"], "left_semi").drop("refresh")
