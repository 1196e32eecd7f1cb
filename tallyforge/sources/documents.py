"""Document stage: listing, text extraction, file-name keys, truncate-and-load.

The stage is any DataFrame of ``(file_name, content)``; ``read_documents``
builds one from a directory (``binaryFile`` lists files without reading them
on the driver). Extraction is re-aimed at text formats: plain text passes
through, HTML is reduced to text with a chain of built-in ``regexp_replace``
calls. PDF/OCR parsing is not built (see README).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import FISCAL_PERIOD_PATTERN, SYMBOL_PATTERN, regex_key

LOADED_AT = "2026-01-01 00:00:00"


def _glob(pattern: str) -> str:
    """A LIKE pattern as a case-insensitive file glob."""
    out = []
    for ch in pattern:
        if ch.isalpha():
            out.append(f"[{ch.lower()}{ch.upper()}]")
        else:
            out.append({"%": "*", "_": "?"}.get(ch, "\\" + ch if ch in "*?[]{}\\" else ch))
    return "".join(out)


def read_documents(spark: SparkSession, path: str, pattern: str = "%.pdf",
                   recursive: bool = True) -> DataFrame:
    """One row per file under ``path`` whose name matches ``pattern``
    case-insensitively: ``(file_name, path, content, error)``.

    Other files are left out at listing time, so their bytes are never read. The
    content is decoded as UTF-8; a file that is no UTF-8 text (a binary PDF, say)
    has NULL content and says so in ``error`` instead of ending the job.
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", str(recursive).lower())
          .option("pathGlobFilter", _glob(pattern))
          .load(path))
    name = F.regexp_extract(F.col("path"), r"([^/]+)$", 1)
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    return df.select(name.alias("file_name"), "path", F.when(valid, text).alias("content"),
                     F.when(~valid, F.lit("not UTF-8 text")).alias("error"))


def html_to_text(c: Column | str) -> Column:
    """Visible text of an HTML page: drop script/style blocks and comments,
    turn tags into spaces, decode the common entities, collapse whitespace."""
    col = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(col, r"(?is)<script\b.*?</script>", " ")
    t = F.regexp_replace(t, r"(?is)<style\b.*?</style>", " ")
    t = F.regexp_replace(t, r"(?s)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]*>", " ")
    # Entity decoding table (&amp; last so "&amp;lt;" stays "&lt;").
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = F.regexp_replace(t, r"[ \t\n\r\f]+", " ")
    return F.regexp_replace(t, r"^ +| +$", "")


def extract_text(name_col: str = "file_name", content_col: str = "content") -> Column:
    """Text of a document by its file type: HTML pages are reduced to their
    visible text, text files pass through unchanged."""
    is_html = F.lower(F.col(name_col)).rlike(r"\.(html?|xhtml)$")
    return F.when(is_html, html_to_text(content_col)).otherwise(F.col(content_col))


def document_keys(df: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Add ``symbol`` (SYMnnn) and ``fiscal_period`` (20yyQn) parsed from the
    file name; NULL where the name carries no such key."""
    return df.withColumn("symbol", regex_key(name_col, SYMBOL_PATTERN)) \
             .withColumn("fiscal_period", regex_key(name_col, FISCAL_PERIOD_PATTERN))


def transcripts_raw(stage: DataFrame, pattern: str = "%.pdf", loaded_at: str = LOADED_AT) -> DataFrame:
    """Landing relation of the transcripts: files matching ``pattern``
    (case-insensitive), keys from the name, text by file type, load time, and the
    file's path where the stage has one (a file name may repeat in other folders)."""
    kept = stage.filter(F.col("file_name").ilike(pattern))
    return document_keys(kept).select(
        "file_name", "symbol", "fiscal_period",
        extract_text("file_name", "content").alias("parsed_text"),
        F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
        *(["path"] if "path" in stage.columns else []))


def land_documents(stage: DataFrame, path: str, pattern: str = "%.pdf",
                   loaded_at: str = LOADED_AT, fmt: str = "parquet") -> None:
    """Truncate-and-load the transcript landing table at ``path``."""
    transcripts_raw(stage, pattern, loaded_at).write.mode("overwrite").format(fmt).save(path)


def preview(df: DataFrame, col: str, n: int = 80, alias: str | None = None) -> DataFrame:
    """``LEFT(col, n)`` per row."""
    return df.withColumn(alias or f"{col}_preview", F.substring(F.col(col), 1, n))
