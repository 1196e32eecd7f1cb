"""Helpers shared by the operators: table reads, text batches, digests."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_path, scratch_folder

# Text that one numpy pass inside a task works on at most (one longer document
# is a pass of its own): bounds the working memory of a Python worker.
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES,
           max_rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a record batch into runs of rows holding about ``max_bytes`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and (held + n > max_bytes or i - begin >= max_rows):
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield batch.slice(begin)


def runs(texts: list[str], max_chars: int) -> Iterator[list[str]]:
    """Cut a list of texts into runs of about ``max_chars`` characters."""
    begin, held = 0, 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) > max_chars:
            yield texts[begin:i]
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield texts[begin:]


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


# Words of a bitmap that travel together, as bytes.
PIECE_WORDS = 1 << 16


def _pieces(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """The bitmap's pieces among the (word, bits) of a task, as bytes."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        word, bits = batch.column("word").to_numpy(), batch.column("bits").to_numpy().view(np.uint64)
        piece = word // words
        for p in np.unique(piece).tolist():
            own = piece == p
            found.setdefault(p, np.zeros(words, np.uint64))[word[own] % words] = bits[own]
    for p, values in found.items():
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([values.tobytes()], pa.binary())], ["piece", "words"])


def hash_bitmap(df: DataFrame, column: str, bits: int):
    """Broadcast bitmap of the top ``bits`` bits of a long column, as uint64 words. The
    tasks make its pieces; the driver receives 2 ** (bits - 3) bytes at most, however
    many rows there are, and never a row per word."""
    top = F.shiftrightunsigned(F.col(column), 64 - bits)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(`{column}`, {64 - bits}) & 63 as int))")
    size = 1 << (bits - 6)
    own = min(size, PIECE_WORDS)
    words = df.groupBy(F.shiftright(top, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    dealt = words.repartition(size // own, F.shiftright("word", own.bit_length() - 1))
    pieces = dealt.mapInArrow(lambda batches: _pieces(batches, own), "piece long, words binary").toArrow()
    bitmap = np.zeros(size, np.uint64)
    for piece, values in zip(*pieces.columns):
        at = piece.as_py() * own
        bitmap[at:at + own] = np.frombuffer(values.as_buffer(), np.uint64)
    return df.sparkSession.sparkContext.broadcast(bitmap)


def in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each uint64 hash may be in the bitmap."""
    top = hashes >> np.uint64(64 - (6 + len(bitmap).bit_length() - 1))
    return (bitmap[top >> np.uint64(6)] >> (top & np.uint64(63))) & np.uint64(1) == 1


# Bits of the bitmaps that keep rows out of joins: 2 MB, whatever the tables' sizes.
FILTER_BITS = 24


def anti_join(docs: DataFrame, key: Column, dropped: DataFrame, dropped_key: str, condition: Column) -> DataFrame:
    """Rows of ``docs`` (aliased ``docs`` in ``condition``) without a match in ``dropped``.

    A bitmap of the dropped keys lets the rows that certainly stay pass where they
    are; only the others, the dropped ones and a few more, go through the exact
    join. So a filter that drops a tenth of the documents moves a tenth of the
    texts. ``key`` and ``dropped_key`` are 64-bit hashes of what is matched.
    """
    bitmap = hash_bitmap(dropped, dropped_key, FILTER_BITS)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, h.to_numpy(np.int64).view(np.uint64)))

    flagged = maybe(key)
    possible = docs.filter(flagged).alias("docs").join(dropped, condition, "left_anti")
    return docs.filter(~flagged).unionByName(possible)


class Scratch:
    """Tables of one computation, in one folder below the shared scratch root; they are
    read again from there, so a lost executor costs no earlier stage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_folder(spark, name)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def remove(self) -> None:
        """Delete the folder; nothing may read its tables any more."""
        remove_path(self.spark, self.root)
