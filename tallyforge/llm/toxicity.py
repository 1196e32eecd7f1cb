"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; all other text is unlabelled, not
negative. With the class prior p the risk of a scorer f is

    p * E_P[loss(f, +)] + max(0, E_U[loss(f, -)] - p * E_P[loss(f, -)])

where the second part estimates the risk on the (unseen) negatives and is kept
from going below zero: when a minibatch drives it there, the step goes back up
that part's gradient instead. An ensemble of linear classifiers over the distinct
words of a text is trained with numpy, each on its own order and feature hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling
from .common import Scratch, held_out, runs, slices, texts_of
from .features import BITS, SLICE, word_features

POSITIVE_DOCS = 6000      # confirmed documents trained on, at most
UNLABELLED_DOCS = 12000   # unlabelled documents trained on, at most
PRIOR_DOCS = 50_000       # labelled rows the class prior is counted on, at most
MEMBERS = 3
EPOCHS = 40
BATCH = 8192              # large, as the bound on the negative risk holds for a batch's mean
RATE = 0.5
MIN_Z = 4.0               # a word gets a weight if its share of the positives stands out by so many deviations
DECAY = 1e-5
THRESHOLD = 0.5


@dataclass
class Model:
    """Averaged weights of the ensemble: one per word bucket, and an offset."""

    weights: np.ndarray
    offset: float


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _matrix(docs: list[np.ndarray], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat bucket list and row starts, with rare buckets left out."""
    own = [d[keep[d]] for d in docs]
    return (np.concatenate(own) if own else np.zeros(0, np.int64)), np.concatenate([[0], np.cumsum([len(d) for d in own])]).astype(np.int64)


def _take(flat: np.ndarray, starts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    parts = [flat[starts[r]:starts[r + 1]] for r in rows]
    return np.concatenate(parts), np.repeat(np.arange(len(rows)), [len(p) for p in parts])


def distinctive(own: np.ndarray, rest: np.ndarray, n_own: int, n_rest: int, min_z: float) -> np.ndarray:
    """Buckets whose document share among the ``n_own`` positives differs from the
    unlabelled share by at least ``min_z`` standard deviations, from the documents that
    hold each. With few positives and many rare words, everything else would only be
    memorised."""
    own, rest = own / n_own, (rest + 1) / (n_rest + 2)
    return np.abs(own - rest) >= min_z * np.sqrt(rest * (1 - rest) / n_own + 1 / n_own ** 2)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, members: int = MEMBERS, epochs: int = EPOCHS,
          batch: int = BATCH, rate: float = RATE, min_z: float = MIN_Z, decay: float = DECAY, bits: int = BITS, seed: int = 0) -> Model:
    """Adagrad on the non-negative risk with the logistic loss. Without positives, or
    without unlabelled documents, the model scores the prior everywhere."""
    size = 1 << bits
    base = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return Model(np.zeros(size, np.float32), base)
    held = [np.bincount(np.concatenate(x), minlength=size) for x in (positive, unlabelled)]
    keep = distinctive(*held, len(positive), len(unlabelled), min_z)
    p_flat, p_starts = _matrix(positive, keep)
    u_flat, u_starts = _matrix(unlabelled, keep)
    weights = np.zeros(size)
    for member in range(members):
        rng = np.random.default_rng(seed + member)
        w, b = np.zeros(size), base
        g2, b2 = np.full(size, 1e-8), 1e-8
        for epoch in range(epochs):
            lr = rate * (1 - epoch / epochs)
            order = rng.permutation(len(unlabelled))
            for begin in range(0, len(order), batch):
                rows = order[begin:begin + batch]
                uf, ur = _take(u_flat, u_starts, rows)
                pf, pr = _take(p_flat, p_starts, picked := rng.integers(0, len(positive), min(batch, len(positive))))
                su = _sigmoid(b + np.bincount(ur, w[uf], len(rows)))
                sp = _sigmoid(b + np.bincount(pr, w[pf], len(picked)))
                negative = -np.log(1 - su + 1e-12).mean() + prior * np.log(1 - sp + 1e-12).mean()
                # derivative of each document's loss by its score
                u_grad = su / len(rows)
                p_plus, p_minus = prior * (sp - 1) / len(picked), -prior * sp / len(picked)
                if negative >= 0:
                    du, dp = u_grad, p_plus + p_minus
                else:
                    du, dp = -u_grad, -p_minus
                g = np.bincount(uf, du[ur], size) + np.bincount(pf, dp[pr], size)
                hit = np.flatnonzero(g)
                gh = g[hit] + decay * w[hit]
                g2[hit] += gh * gh
                w[hit] -= lr * gh / np.sqrt(g2[hit])
                gb = du.sum() + dp.sum()
                b2 += gb * gb
                b -= lr * gb / np.sqrt(b2)
        weights += w / members
    return Model(weights.astype(np.float32), risk_offset(np.array([weights[d].sum() for d in positive]),
                                                         np.array([weights[d].sum() for d in unlabelled]), prior))


def risk_offset(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """Offset that puts probability 0.5 where the same risk with the zero-one loss is
    least (amid the best cuts). The bound on the negative risk stops training
    before the scores of both sides reach 0.5 by themselves."""
    cuts = np.unique(np.concatenate([positive, unlabelled]))
    cuts = np.concatenate([[cuts[0] - 1], (cuts[1:] + cuts[:-1]) / 2, [cuts[-1] + 1]])
    hit = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    flagged = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    risk = prior * (1 - hit) + np.maximum(0, flagged - prior * hit)
    best = cuts[risk <= risk.min() + 1e-9]
    return -float((best[0] + best[-1]) / 2)


def probabilities(texts: list[str], weights: np.ndarray, offset: float) -> np.ndarray:
    owner, buckets = word_features(texts)
    return _sigmoid(offset + np.bincount(owner, weights[buckets], len(texts)))


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            owner, buckets = word_features(texts_of(batch, "text"))
            parts = np.split(buckets.astype("<u4"), np.searchsorted(owner, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("positive"), pa.array([p.tobytes() for p in parts], pa.binary())],
                ["doc_id", "positive", "features"])


def fit(docs: DataFrame, labels: DataFrame, target: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        positive_docs: int = POSITIVE_DOCS, unlabelled_docs: int = UNLABELLED_DOCS) -> Model:
    """Train on at most ``positive_docs`` confirmed and ``unlabelled_docs`` unlabelled
    documents, all outside the held-out fold; the prior is the confirmed share of
    at most ``PRIOR_DOCS`` labelled rows. Distinctive word buckets are chosen from counts
    in Spark and the driver receives those of these documents. Only text is an input."""
    known = sampling.training_labels(labels, target)
    counted = sampling.drawn(known, PRIOR_DOCS, seed=3).agg(F.avg("label").alias("p"), F.count("*").alias("n")).first()
    prior = min(max((counted["p"] or 0) * 1.0, 1e-3), 0.5) if counted["n"] else 0.01
    positive = sampling.drawn(known.filter(F.col("label") == 1), positive_docs, seed=5).select("doc_id", F.lit(1).alias("positive"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    unlabelled = sampling.drawn(ids, unlabelled_docs, seed=6).select("doc_id", F.lit(0).alias("positive"))
    stored = Scratch(docs.sparkSession, "toxicity").store(sampling.with_texts(positive.union(unlabelled), docs, id_col, text_col).mapInArrow(
        _draw, "doc_id long, positive int, features binary"), "features")
    keep = _kept_buckets(stored)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = [np.frombuffer(f, "<u4") for f in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"),
                                              pa.array([f[keep[f]].tobytes() for f in features], pa.binary())], ["doc_id", "positive", "features"])

    rows = stored.mapInArrow(reduce, stored.schema).toPandas().sort_values(["doc_id", "positive"], kind="stable")
    found = {k: [np.frombuffer(f, "<u4").astype(np.int64) for f in rows["features"][rows["positive"] == k]] for k in (0, 1)}
    return train(found[1], found[0], prior)


def _kept_buckets(stored: DataFrame, bits: int = BITS, min_z: float = MIN_Z) -> np.ndarray:
    """The distinctive buckets, from their document counts in Spark: at most 2 ** bits
    counts of each side reach the driver, however long the texts are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << bits), np.int64)
        for batch in batches:
            for positive, f in zip(batch.column("positive").to_pylist(), batch.column("features").to_pylist()):
                held[positive, np.frombuffer(f, "<u4")] += 1            # distinct buckets of a document
        side, bucket = np.nonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(side, pa.int32()), pa.array(bucket, pa.int64()), pa.array(held[side, bucket])], ["side", "bucket", "n"])

    counts = stored.mapInArrow(count, "side int, bucket long, n long").groupBy("side", "bucket").agg(F.sum("n").alias("n")).toPandas()
    docs = {r["positive"]: r["count"] for r in stored.groupBy("positive").count().collect()}
    if not docs.get(0) or not docs.get(1):
        return np.zeros(1 << bits, bool)
    held = np.zeros((2, 1 << bits), np.int64)
    held[counts["side"].to_numpy(), counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return distinctive(held[1], held[0], docs[1], docs[0], min_z)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (double, 0 to 1) in front, replacing one of that
    name. Whole texts; null counts as empty. Map-only."""
    kept = [c for c in docs.columns if c != name]
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.offset))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [probabilities(own, *shared.value) for own in runs(list(texts), SLICE)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(probability(text).alias(name), *[F.col(f"`{c}`") for c in kept])


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, target: str = "toxic") -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``: doc_id, held_out, score,
    predicted (1 if score >= threshold).

    Null and repeated ids are ordinary rows (a null id is not held out); null
    texts count as empty; without usable labels every score is the lowest prior;
    an empty table gives no rows; columns beyond doc_id and text are ignored.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, target))
    return scored.select(*sampling.score_columns(F.col("doc_id"), F.col("score"), threshold))
