"""Quality classifier with supervised subword embeddings.

A document is the average of learned vectors of its words and of the character
3- and 4-grams inside them (all hashed into one table); a softmax layer on the
average gives the classes. Table and layer are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled documents.

Scoring reads whole texts: since the layer is linear, the average of vectors
times the layer is the average of one number per bucket, so a task needs only
that table (2**18 floats, 1 MB).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sampling
from .common import runs, slices, texts_of
from .features import BITS, SLICE, subword_features

SAMPLE_DOCS = 8000        # labelled documents a model is trained on, at most
SAMPLE_FEATURES = 768     # feature occurrences drawn from each of them
DIM = 16
EPOCHS = 6
RATE = 0.5
BATCH = 32
THRESHOLD = 0.3


@dataclass
class Model:
    """Vectors of the buckets, output layer and biases of the two classes."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def table(self) -> tuple[np.ndarray, float]:
        """One number per bucket and the offset of the log odds of class 1."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0]), float(self.bias[1] - self.bias[0])


def train(features: list[np.ndarray], labels: np.ndarray, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE,
          batch: int = BATCH, bits: int = BITS, seed: int = 0) -> Model:
    """Minibatch SGD on the cross-entropy of the softmax of averaged vectors. A document
    without features trains the biases only; without documents the model gives 0.5."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32),
                  np.zeros((dim, 2), np.float32), np.zeros(2, np.float32))
    n = len(labels)
    steps, step = epochs * -(-n // batch), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for begin in range(0, n, batch):
            own = order[begin:begin + batch]
            lr = rate * (1 - step / steps)
            step += 1
            sizes = np.array([len(features[i]) for i in own])
            flat = np.concatenate([features[i] for i in own]).astype(np.int64)
            rows = np.repeat(np.arange(len(own)), sizes)
            mean = np.zeros((len(own), dim), np.float32)
            full = np.flatnonzero(sizes)
            if len(full):
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[full]
                mean[full] = np.add.reduceat(model.vectors[flat], starts, axis=0) / sizes[full, None]
            logits = mean @ model.layer + model.bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), labels[own]] -= 1          # gradient of the logits
            back = (p @ model.layer.T) / np.maximum(sizes, 1)[:, None]
            buckets, where = np.unique(flat, return_inverse=True)
            lr *= min(1.0, STEEPEST * step_limit(model, mean, rows, sizes, where, lr))
            model.layer -= lr * (mean.T @ p)
            model.bias -= lr * p.sum(axis=0) / len(own)
            update = np.stack([np.bincount(where, back[rows, d], len(buckets)) for d in range(dim)], axis=1)
            model.vectors[buckets] -= (lr * VECTOR_RATE * update).astype(np.float32)
    return model


# The averaged vectors see gradients scaled by 1 / (features of a document); this
# brings their steps to the size of the layer's.
VECTOR_RATE = 40.0
# Most that a step may change the logits, as a multiple of their error. Ordinary corpora
# stay below it (767 at most was measured); where many documents of a batch share their
# features, vectors and layer would drive each other beyond the range of floats.
STEEPEST = 1024.0


def step_limit(model: Model, mean: np.ndarray, rows: np.ndarray, sizes: np.ndarray, where: np.ndarray, rate: float) -> float:
    """One over what a step of ``rate`` changes the logits by, relative to their error: by the
    vectors that documents of the batch share, and by the layer."""
    share = 1 / np.maximum(sizes, 1)
    common = np.bincount(where, share[rows])                          # of each bucket, over the batch
    overlap = np.bincount(rows, common[where], len(sizes)) * share
    weight = (model.layer[:, 1] - model.layer[:, 0]).astype(np.float64)
    change = VECTOR_RATE * overlap.max() * (weight @ weight) + 2 * len(sizes) * (mean.astype(np.float64) ** 2).sum(axis=1).max()
    return 1 / max(rate * change, 1e-9)


def _draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE):
            texts = texts_of(batch, "text")
            owner, buckets = subword_features(texts)
            order = np.argsort(owner, kind="stable")
            parts = np.split(buckets[order], np.searchsorted(owner[order], np.arange(1, len(texts))))
            drawn = [(np.random.default_rng(zlib.crc32(t.encode())).choice(p, SAMPLE_FEATURES) if len(p) > SAMPLE_FEATURES else p)
                     .astype("<u4").tobytes() for t, p in zip(texts, parts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(drawn, pa.binary())], ["doc_id", "label", "features"])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", id_col: str = "doc_id", text_col: str = "text",
        sample_docs: int = SAMPLE_DOCS) -> Model:
    """Train on at most ``sample_docs`` labelled documents outside the held-out fold.
    Features are drawn in the tasks; the driver receives ``sample_docs`` rows of
    at most 3 KB. Only text is an input."""
    sample = sampling.drawn(sampling.training_labels(labels, target), sample_docs, seed=9)
    rows = sampling.with_texts(sample, docs, id_col, text_col).mapInArrow(
        _draw, "doc_id long, label int, features binary").toPandas().sort_values("doc_id", kind="stable")
    return train([np.frombuffer(f, "<u4") for f in rows["features"]], rows["label"].to_numpy(np.int64))


def probabilities(texts: list[str], table: np.ndarray, offset: float) -> np.ndarray:
    """Probabilities of class 1 of texts, from the model's table."""
    owner, buckets = subword_features(texts)
    n = np.bincount(owner, minlength=len(texts))
    total = np.bincount(owner, table[buckets], len(texts))
    return 1 / (1 + np.exp(-np.clip(offset + total / np.maximum(n, 1), -500, 500)))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (double, 0 to 1) put in front of the others, an
    existing column of that name being replaced. Whole texts; null counts as
    empty, and an empty text scores the prior. Map-only."""
    kept = [c for c in docs.columns if c != name]
    shared = docs.sparkSession.sparkContext.broadcast(model.table())

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [probabilities(own, *shared.value) for own in runs(list(texts), SLICE)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(probability(text).alias(name), *[F.col(f"`{c}`") for c in kept])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, target: str = "quality") -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``: doc_id, held_out, score,
    predicted (1 if score >= threshold).

    Null and repeated ids are ordinary rows (a null id is not held out); null
    texts count as empty; without usable labels every score is 0.5; an empty
    table gives no rows; columns beyond doc_id and text are ignored.
    """
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, target))
    return scored.select(*sampling.score_columns(F.col("doc_id"), F.col("score"), threshold))
