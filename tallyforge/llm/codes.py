"""Vector code compression: product codes with codebooks trained over distinct parts.

A vector's components become integers floor(1024 * x) and are cut into ``PARTS`` equal
consecutive parts. Every part position has a codebook of at most ``ENTRIES`` entries;
a part's code is its nearest entry by squared Euclidean distance, ties to the lower
index. All arithmetic is exact on 64-bit integers.

Method: the distinct parts of a position, in lexicographic order, are the leaves of a
trie whose levels are the components. A depth-first walk carries the vector of squared
distances to all entries, accumulated over the components passed; parts with a common
prefix share it. A leaf takes the argmin and adds its part, times the number of rows
that hold it, to the entry's sums. Small subtrees are expanded level by level in one
numpy step, so a walk holds one distance vector per level above them and ``BLOCK``
vectors below.

Distinct parts are counted per batch, dealt by ranges of (position, part), so that a
task's trie shares long prefixes, and stored once. A part that a third of all rows
share arrives as one row per batch. Each round reads the stored parts; per task at most
PARTS * ENTRIES sums leave it. Codebooks (at most PARTS * ENTRIES entries, whatever the
table's size) travel through the driver. The codes of the rows are found where the rows
lie, by a trie over each batch's distinct parts: no join, no shuffle of vectors.

Rows are dropped whose vector is null or empty, or holds null or non-finite components.
The dimension is that of the smallest kept vec_id; it must divide by PARTS, else there
are no codes; vectors of another length are dropped, and so are those with a component
of ``LIMIT`` or more after scaling, whose squares would not fit 64 bits. Null vec_ids
are coded but start no entry; of repeated vec_ids the least vector starts one. With
fewer than ENTRIES vec_ids the codebooks are smaller. Labels may be null (one group).
Extra columns pass through ``codes``; columns named like an output are replaced. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LIMIT = 1 << 26
BLOCK = 512                # leaves of a subtree that is expanded in one step


# ------------------------------------------------------------------ the trie

def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each row of ``parts``, which is
    sorted lexicographically. Depth first; see the module's docstring."""
    n, depth = parts.shape
    index, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    columns = np.ascontiguousarray(entries.T)
    # rows at which a new child begins, at each level: where a component or one before it changes
    fresh = np.ones((n, depth), bool)
    fresh[1:] = np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1)

    def expand(lo: int, hi: int, level: int, reached: np.ndarray) -> None:
        """The leaves lo..hi below one node, level by level."""
        acc, node = reached[None], np.zeros(hi - lo, np.int64)
        for d in range(level, depth):
            new = fresh[lo:hi, d].copy()
            new[0] = True
            first = np.flatnonzero(new)
            gap = parts[lo + first, d][:, None] - columns[d]
            acc = acc[node[first]] + gap * gap
            node = np.cumsum(new) - 1
        best = acc.argmin(axis=1)
        index[lo:hi], distance[lo:hi] = best[node], acc[np.arange(len(best)), best][node]

    stack = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while stack:
        lo, hi, level, reached = stack.pop()
        if hi - lo <= BLOCK or level == depth:
            expand(lo, hi, level, reached)
            continue
        new = fresh[lo:hi, level].copy()
        new[0] = True
        children = np.append(lo + np.flatnonzero(new), hi)
        begin = 0
        while begin < len(children) - 1:
            end = max(begin + 1, int(np.searchsorted(children, children[begin] + BLOCK, side="right")) - 1)
            a, b = int(children[begin]), int(children[end])
            if end > begin + 1:                  # several small children: one step from this node
                expand(a, b, level, reached)
            else:
                gap = parts[a, level] - columns[level]
                stack.append((a, b, level + 1, reached + gap * gap))
            begin = end
    return index, distance


def distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows in lexicographic order, the distinct row of each row, and counts."""
    order = np.lexsort(rows.T[::-1])
    ordered = rows[order]
    new = np.ones(len(rows), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
    where = np.empty(len(rows), np.int64)
    where[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return ordered[first], where, np.diff(first, append=len(rows))


# --------------------------------------------------------------------- Spark

def _packed(parts: np.ndarray) -> pa.Array:
    """Rows as byte strings whose order is the rows' order."""
    raw = (parts + (1 << 31)).astype(">u4").tobytes()
    width = 4 * parts.shape[1]
    return pa.array([raw[i:i + width] for i in range(0, len(raw), width)], pa.binary())


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.int64).reshape(-1, width) - (1 << 31)


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of integers, all of one length, as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def quantised(vec_col: str) -> Column:
    """floor(SCALE * x) of every component, or null where a vector is dropped."""
    x = F.col(vec_col).cast("array<double>")
    fit = F.forall(x, lambda v: F.coalesce((v * SCALE >= -LIMIT) & (v * SCALE < LIMIT), F.lit(False)))   # false for NaN too
    return F.when(F.coalesce(fit, F.lit(False)) & (F.size(x) > 0), F.transform(x, lambda v: F.floor(v * SCALE).cast("int")))


def codebooks(vectors: DataFrame, id_col: str, q_col: str, scratch: Scratch, entries: int = ENTRIES,
              rounds: int = ROUNDS) -> np.ndarray:
    """Trained codebooks as an array (part, entry, component) from quantised vectors."""
    some = vectors.filter(F.col(id_col).isNotNull())
    ids = some.select(id_col).distinct().orderBy(id_col).limit(entries).collect()
    if not ids:
        return np.zeros((PARTS, 0, 0), np.int64)
    first = (some.filter(F.col(id_col) <= F.lit(ids[-1][0])).groupBy(id_col).agg(F.min(q_col).alias("q"))
             .orderBy(id_col).toArrow())                                      # at most ``entries`` rows
    books = _matrix(first.column("q").combine_chunks()).astype(np.int64)
    width = books.shape[1] // PARTS
    books = np.ascontiguousarray(books.reshape(-1, PARTS, width).transpose(1, 0, 2))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(0)).astype(np.int64).reshape(-1, PARTS, width)
            for p in range(PARTS):
                parts, _, n = distinct_rows(rows[:, p])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), p, np.int32)), _packed(parts), pa.array(n, pa.int64())],
                                                 ["position", "part", "n"])

    distinct = scratch.store(
        vectors.select(q_col).mapInArrow(split, "position int, part binary, n long")
        .repartitionByRange("position", "part").groupBy("position", "part").agg(F.sum("n").alias("n"))
        .sortWithinPartitions("position", "part"), "parts")
    sums = [f"s{i}" for i in range(width)]
    schema = "position int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)

    def assign(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, books.shape[1], width + 1), np.int64)
        for batch in batches:
            position, n = batch.column("position").to_numpy(), batch.column("n").to_numpy()
            rows = _unpacked(batch.column("part"), width)
            for p in np.unique(position).tolist():
                here = position == p
                index, _ = nearest(rows[here], shared.value[p])
                np.add.at(total[p], index, np.column_stack([n[here], rows[here] * n[here][:, None]]))
        p, e = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()),
                                          *(pa.array(total[p, e, i]) for i in range(width + 1))], ["position", "entry", "n", *sums])

    for _ in range(rounds):
        shared = distinct.sparkSession.sparkContext.broadcast(books)          # PARTS * entries entries
        found = (distinct.mapInArrow(lambda b, s=shared: assign(s, b), schema)
                 .groupBy("position", "entry").agg(*(F.sum(c).alias(c) for c in ["n", *sums])).toArrow())
        table = np.column_stack([found.column(c).to_numpy() for c in found.column_names])
        books = books.copy()
        books[table[:, 0], table[:, 1]] = table[:, 3:] // table[:, 2:3]       # floors go down
    return books


def codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", entries: int = ENTRIES,
          rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(kept rows of ``vectors`` with ``code`` (hex, two digits per part) and ``error``
    (squared distance summed over the parts), the codebooks)."""
    scratch = Scratch(vectors.sparkSession, "codes")
    out = ["code", "error"]
    rest = [c for c in vectors.columns if c not in out]
    q = vectors.select(F.struct(*rest).alias("row"), quantised(vec_col).alias("q")).filter("q IS NOT NULL")
    least = (q.select(F.col("row").getField(id_col).alias("i"), F.size("q").alias("n")).filter("i IS NOT NULL").orderBy("i", "n").limit(1).collect())
    dimension = least[0]["n"] if least else 0
    q = q.filter(F.size("q") == dimension) if dimension and dimension % PARTS == 0 else q.limit(0)
    kept = scratch.store(q.select(F.col("row").getField(id_col).alias("i"), "q"), "vectors")
    books = codebooks(kept, "i", "q", scratch, entries, rounds)
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column("q")).astype(np.int64).reshape(batch.num_rows, PARTS, -1)
            code, error = [], np.zeros(batch.num_rows, np.int64)
            for p in range(PARTS):
                parts, where, _ = distinct_rows(rows[:, p])
                index, distance = nearest(parts, shared.value[p])
                code.append(index[where])
                error += distance[where]
            text = np.column_stack(code).astype(np.uint8).tobytes().hex()
            text = [text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(text), pa.array(error)], ["row", *out])

    coded = q.mapInArrow(encode, f"row {q.schema['row'].dataType.simpleString()}, code string, error long")
    return coded.select("row.*", *out), books


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' decimal components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
