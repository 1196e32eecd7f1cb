"""Approximate vector search: cells of similar vectors, the nearest cells probed, exact scores.

``VectorCells.build`` trains cell centres by spherical k-means on a sample (``SAMPLE_PER_CELL``
rows a cell, drawn by a hash of the id: the bound is documented and the only sampling),
gives *every* row its cell and stores the rows by cell. ``search`` scores the rows of each
query's nearest cells with the stored vectors themselves, so a returned score is exact
and only a neighbour outside the probed cells can be missed. The number of cells probed
is the least that reaches ``TARGET`` of the sample's own neighbours when the index is
built; ``recall`` measures what it reaches against the exact route, ``search.cosine_topk``.

Scale: centres are at most ``MAX_CELLS`` rows and travel as one matrix; rows are never
collected. Rows of a large cell (one vector may hold a third of all) are dealt into
chunks of about ``CHUNK_ROWS``, in the files and in the search, where a chunk of a cell
meets a block of the queries that probe it: a bounded numpy step each. A request opens
the folders of its cells only.

NULL, zero and non-finite vectors and those of another length than the first centre have
no cell and never rank. Ids keep their type; ties rank by id.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .search import SCORE_DIGITS, _Best, _matrix, _topk, cosine_topk

SAMPLE_PER_CELL = 64
MAX_CELLS = 4096
PARTS = 64                # folders that the cells are dealt into
CHUNK_ROWS = 20_000
BLOCK_QUERIES = 2_000
ITERATIONS = 10
TARGET = 0.97             # share of the sample's neighbours that calibration reaches
_CALIBRATION_QUERIES = 200


def _unit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows, and which rows have a direction."""
    norms = np.linalg.norm(rows, axis=1)
    ok = np.isfinite(norms) & (norms > 0)
    return rows / np.where(ok, norms, 1)[:, None], ok


def train(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Cell centres: spherical k-means over unit vectors; an empty cell takes a random row."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(ITERATIONS):
        own = _nearest(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        empty = np.flatnonzero(np.bincount(own, minlength=len(centres)) == 0)
        sums[empty] = sample[rng.integers(0, len(sample), len(empty))]
        centres, ok = _unit(sums)
        centres[~ok] = sample[rng.integers(0, len(sample), (~ok).sum())]
    return centres


def _nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest cells of each row, the nearest first; in steps of bounded memory."""
    out = np.empty((len(rows), min(n, len(centres))), np.int64)
    step = max(1, (1 << 22) // max(len(centres), 1))
    for begin in range(0, len(rows), step):
        out[begin:begin + step] = np.argsort(-(rows[begin:begin + step] @ centres.T), axis=1, kind="stable")[:, :n]
    return out


def calibrate(sample: np.ndarray, centres: np.ndarray, k: int, target: float = TARGET) -> int:
    """The least number of cells to probe that holds ``target`` of the k nearest neighbours
    of some sample rows among the sample."""
    asked = sample[:: max(1, len(sample) // _CALIBRATION_QUERIES)]
    own = _nearest(sample, centres, 1)[:, 0]
    scores = asked @ sample.T
    best = np.argsort(-scores, axis=1, kind="stable")[:, 1:k + 1]          # without the row itself
    order = _nearest(asked, centres, len(centres))
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None].repeat(len(order), 0), axis=1)
    needed = np.sort(np.take_along_axis(place, own[best], axis=1).ravel()) + 1
    return int(needed[min(len(needed) - 1, math.ceil(target * len(needed)) - 1)]) if len(needed) else 1


def _rows(vectors: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; NULL rows and rows of another length become zero rows."""
    out = np.zeros((len(vectors), width))
    lengths = np.array([-1 if n is None else n for n in vectors.value_lengths().to_pylist()], np.int64)
    ok = lengths == width
    fit = vectors.filter(pa.array(ok))
    if ok.any():
        flat = fit.flatten()
        out[ok] = np.nan_to_num(flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width),
                                nan=np.inf, posinf=np.inf, neginf=np.inf)
    return out


@dataclass
class VectorCells:
    spark: SparkSession
    root: str
    centres: np.ndarray
    probes: int
    counts: dict[int, int]

    @classmethod
    def build(cls, corpus: DataFrame, root: str, id_col: str = "vec_id", vec_col: str = "embedding", cells: int | None = None,
              k: int = 10) -> VectorCells:
        spark = corpus.sparkSession
        rows = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")).filter("vec IS NOT NULL AND size(vec) > 0")
        n = rows.count()
        cells = cells or max(1, min(MAX_CELLS, round(2 * math.sqrt(n))))
        drawn = rows.orderBy(F.xxhash64("id"), "id").limit(cells * SAMPLE_PER_CELL).toArrow()     # bounded, see above
        if not drawn.num_rows:
            return cls(spark, root, np.zeros((0, 0)), 0, {})
        vecs = drawn.column("vec").combine_chunks()
        sample, ok = _unit(_rows(vecs, int(vecs.value_lengths()[0].as_py())))
        sample = sample[ok]
        if not len(sample):
            return cls(spark, root, np.zeros((0, 0)), 0, {})
        centres = train(sample, cells)
        shared = spark.sparkContext.broadcast(centres)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit, good = _unit(_rows(batch.column("vec"), shared.value.shape[1]))
                cell = _nearest(unit, shared.value, 1)[:, 0] if len(unit) else np.zeros(0, np.int64)
                kept = pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("id"), batch.column("vec")], ["cell", "id", "vec"])
                yield kept.filter(pa.array(good))

        placed = materialize(rows.mapInArrow(assign, f"cell int, id {rows.schema['id'].dataType.simpleString()}, vec array<double>"), "cells")
        counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}          # at most MAX_CELLS rows
        sizes = F.create_map(*[F.lit(x) for c in counts.items() for x in c]) if counts else F.create_map()
        chunk = F.pmod(F.xxhash64("id"), 1 + F.floor(sizes[F.col("cell")] / CHUNK_ROWS)).cast("int")
        (placed.withColumn("chunk", chunk).withColumn("part", F.col("cell") % PARTS)
         .repartition("part", "chunk").sortWithinPartitions("part", "cell").write.partitionBy("part").parquet(f"{root}/rows"))
        found = cls(spark, root, centres, min(len(centres), calibrate(sample, centres, k)), counts)
        meta = json.dumps({"probes": found.probes, "centres": centres.tolist()})
        spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{root}/centres")
        return found

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> VectorCells:
        meta = json.loads(spark.read.text(f"{root}/centres", wholetext=True).first()["value"])
        rows = spark.read.parquet(f"{root}/rows")
        return cls(spark, root, np.array(meta["centres"]), meta["probes"], {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()})

    def rows_of(self, cells: list[int]) -> DataFrame:
        """Stored rows of some cells: only their folders are opened."""
        found = self.spark.read.parquet(f"{self.root}/rows").filter(F.col("part").isin(sorted({c % PARTS for c in cells})))
        return found.filter(F.col("cell").isin(cells)) if len(cells) < len(self.counts) else found

    def search(self, queries: DataFrame, k: int = 10, qid_col: str = "query_id", qvec_col: str = "embedding",
               probes: int | None = None, id_name: str = "vec_id") -> DataFrame:
        """Top ``k`` rows per query among its ``probes`` nearest cells: ``query_id, rank,
        <id_name>, score``. With as many probes as cells the result is exact."""
        probes = min(len(self.centres), probes or self.probes)
        q = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("qv")).filter("qv IS NOT NULL")
        if not self.counts:
            return q.limit(0).select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_name), F.lit(0.0).alias("score"))
        shared = self.spark.sparkContext.broadcast(self.centres)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit, good = _unit(_rows(batch.column("qv"), shared.value.shape[1]))
                near = _nearest(unit, shared.value, probes) if len(unit) else np.zeros((0, probes), np.int64)
                lists = pa.array([r if ok else [] for r, ok in zip(near.astype(np.int32).tolist(), good.tolist())], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("qv"), lists], ["query_id", "qv", "near"])

        kind = q.schema["query_id"].dataType.simpleString()
        asked = materialize(q.mapInArrow(probe, f"query_id {kind}, qv array<double>, near array<int>"), "probes")
        asked = asked.select("query_id", "qv", F.explode("near").alias("cell"))
        per_cell = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect() if r["cell"] in self.counts}    # at most MAX_CELLS
        if not per_cell:
            return q.limit(0).select("query_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_name), F.lit(0.0).alias("score"))
        chunks = F.create_map(*[F.lit(x) for c in per_cell for x in (c, 1 + self.counts[c] // CHUNK_ROWS)])
        blocks = F.create_map(*[F.lit(x) for c, n in per_cell.items() for x in (c, 1 + n // BLOCK_QUERIES)])

        def dealt(df: DataFrame, own: str, key: str, mine, others) -> DataFrame:
            """Each row in its own chunk (or block), once for every block (or chunk) of its cell."""
            other = "block" if own == "chunk" else "chunk"
            return (df.withColumn(own, F.pmod(F.xxhash64(key), mine[F.col("cell")]).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), others[F.col("cell")] - 1))))

        left = dealt(self.rows_of(list(per_cell)).select("cell", "id", "vec"), "chunk", "id", chunks, blocks)
        right = dealt(asked.filter(F.col("cell").isin(list(per_cell))), "block", "query_id", blocks, chunks)
        id_type = left.schema["id"].dataType

        def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
            best = _Best(_matrix(queries.select(["query_id", "qv"])), k)
            for batch in rows.select(["id", "vec"]).to_batches():
                best.add(batch.column(0), batch.column(1))
            return pa.Table.from_batches([best.rows(["query_id", "id", "score"], rows.schema.field("id").type)])

        key = ["cell", "chunk", "block"]
        scored = (left.groupBy(*key).cogroup(right.groupBy(*key))
                  .applyInArrow(meet, f"query_id {kind}, id {id_type.simpleString()}, score double"))
        top = _topk(scored, "query_id", "id", k)
        return top.select("query_id", "rank", F.col("id").alias(id_name), "score")

    def recall(self, corpus: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
               probes: int | None = None) -> float:
        """Share of the exact top ``k`` (ties at the last place count as found) that ``search`` returns."""
        exact = materialize(cosine_topk(corpus, queries, k, id_col, vec_col), "recall-exact")
        last = exact.groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        got = self.search(queries, k, probes=probes).groupBy("query_id").agg(F.collect_list("score").alias("scores"))
        share = last.join(got, "query_id", "left").select(
            "n", F.least("n", F.size(F.filter(F.coalesce("scores", F.array()), lambda s: s >= F.col("least")))).alias("hit"))
        row = share.agg(F.sum("hit").alias("hit"), F.sum("n").alias("n")).first()
        return row["hit"] / row["n"] if row["n"] else 1.0
