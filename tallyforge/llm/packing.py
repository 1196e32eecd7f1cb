"""Best-fit packing of tokenised documents into fixed-length sequences.

``token_pieces`` tokenises documents and cuts only those longer than a
sequence; ``best_fit`` assigns every piece a sequence and an offset;
``assemble`` builds the token rows of the packed sequences.

The packer is a bounded-space online best fit. Every task streams over its
pieces and keeps at most ``open_bins`` open sequences, found through one
integer used as a bitset over the amounts of free space: the smallest free
space that still holds a piece is two bit operations away. When a new sequence
is needed and the space is used up, the fullest open one closes for good.
Memory is bounded by ``open_bins`` whatever the input. Only lengths travel to
the packing tasks, never tokens.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, texts_of

SEQUENCE_TOKENS = 1024
END_ID = 2
# Open sequences a task keeps: measured fill grows little beyond this.
OPEN_BINS = 4096
# Pieces placed longest first before the next ones are looked at: 99.9 % full
# sequences instead of 99.1 % in the order of arrival.
RUN_PIECES = 10_000

SPECIAL = {"<|endoftext|>": 50256}


@functools.lru_cache(maxsize=2)
def byte_bpe(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file, cached per worker process. It gives the
    ids of the tokenizers file of the same vocabulary (tested against it), in a
    fraction of the time; ``<|endoftext|>`` inside a text is its special token
    there as well."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)


def encode(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    if "<|endoftext|>" in text:
        return np.asarray(enc.encode(text, allowed_special="all"), np.uint32)
    return enc.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: whole if it fits,
    else full pieces with the remainder, if any, in front."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *((s, length) for s in range(first, n, length))]


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType())])


def token_pieces(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, the
    CRC-32 of its ids and, with ``with_ids``, the ids themselves.

    A document is its token ids followed by ``end_id``; a null or empty text is
    the end id alone. Null and repeated ids are ordinary rows (each row is
    tokenised on its own); other columns are ignored. Map-only.
    """
    schema = T.StructType([*PIECES.fields, *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = byte_bpe(ranks_path, pattern)
        for whole in batches:
            for batch in slices(whole, "text"):
                out: list[tuple] = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text"), strict=True):
                    ids = np.append(encode(enc, text), np.uint32(end_id)).astype("<u4")
                    for k, (start, n) in enumerate(cut(len(ids), length)):
                        own = ids[start:start + n]
                        out.append((doc, k, start, n, zlib.crc32(own.tobytes()), *([own.astype(np.int32)] if with_ids else [])))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(col, t) for col, t in zip(zip(*out, strict=True), types, strict=False)], schema.names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        pieces, schema)


class Packer:
    """Bounded-space online best fit over one stream of lengths."""

    def __init__(self, length: int, open_bins: int):
        self.length, self.open_bins = length, open_bins
        self.free = 0                                                  # bit f: some open bin has f free
        self.bins: list[list[int]] = [[] for _ in range(length + 1)]   # open bins by free space
        self.n_open = self.made = 0

    def place(self, n: int) -> tuple[int, int]:
        """(bin, offset) of a piece of ``n`` tokens."""
        if n >= self.length:
            self.made += 1
            return self.made - 1, 0
        if fits := self.free >> n:
            space = n + (fits & -fits).bit_length() - 1                # least free space that holds it
            own = self._take(space)
        else:
            if self.n_open == self.open_bins:
                self._take((self.free & -self.free).bit_length() - 1)  # the fullest closes
            own, space = self.made, self.length
            self.made += 1
        if left := space - n:
            self.bins[left].append(own)
            self.free |= 1 << left
            self.n_open += 1
        return own, self.length - space

    def _take(self, space: int) -> int:
        own = self.bins[space].pop()
        if not self.bins[space]:
            self.free &= ~(1 << space)
        self.n_open -= 1
        return own


def best_fit(pieces: DataFrame, length: int = SEQUENCE_TOKENS, open_bins: int = OPEN_BINS,
             run_pieces: int = RUN_PIECES) -> DataFrame:
    """Add sequence_id and offset to every piece (columns doc_id, piece, length and
    any others except those two names, which are replaced).

    One shuffle deals the pieces out by a hash of (doc_id, piece), so that a
    source or a long document never meets in one task, and each task packs its
    share in hash order, in runs of at most ``run_pieces`` that are placed longest first,
    so a repeated task gives the same answer. The partition count is left to adaptive execution: few, well filled packers on
    small data, many on large data. Sequence ids are unique, not consecutive.
    Pieces longer than ``length`` are an error; an empty table gives no rows.
    """
    if open_bins < 1 or run_pieces < 1:
        raise ValueError("open_bins and run_pieces must be at least 1")
    rest = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    key = F.xxhash64("doc_id", "piece")
    dealt = pieces.select(*rest).repartition(key).sortWithinPartitions(key, "doc_id", "piece", "length")
    schema = T.StructType([*dealt.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = Packer(length, open_bins), TaskContext.get().partitionId() << 36
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            if lengths and max(lengths) > length:
                raise ValueError(f"a piece is longer than a sequence of {length} tokens")
            placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
            for begin in range(0, len(lengths), run_pieces):
                for i in sorted(range(begin, min(begin + run_pieces, len(lengths))), key=lambda i: -lengths[i]):
                    placed[i] = packer.place(lengths[i])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([first + b for b, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())], schema.names)

    return dealt.mapInArrow(pack, schema)


def assemble(packed: DataFrame) -> DataFrame:
    """Token rows of the packed sequences: sequence_id, ids, and the start offset of
    every document piece in it (for attention masks). A group is one sequence,
    so it never holds more than ``length`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return (packed.groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"),
                    F.col("parts.offset").alias("starts"), F.col("parts.doc_id").alias("doc_ids")))
