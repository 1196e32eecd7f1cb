import random
import zlib

import numpy as np
import pytest

from tallyforge.llm import features, quality, queries, toxicity

BAD = ["idiotic", "rotten", "vile"]


def _auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    n = labels.sum()
    return (order[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def _fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def toxic_docs(spark):
    """4000 texts, a tenth toxic; two thirds of them labelled."""
    r = random.Random(4)
    rows, labels = [], []
    for i in range(4000):
        words = [f"w{min(r.randrange(3000), r.randrange(3000))}" for _ in range(r.randint(20, 80))]
        toxic = i % 10 == 3
        if toxic:
            for _ in range(r.randint(2, 4)):
                words.insert(r.randrange(len(words)), r.choice(BAD))
        rows.append((i, " ".join(words), "x"))
        if r.random() < 0.66:
            labels.append((i, int(not toxic), int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_toxicity_on_held_out_rows(toxic_docs):
    got = toxicity.toxicity_scores(*toxic_docs).collect()
    assert len(got) == 4000 and all(r.held_out == _fold(r.doc_id) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    test = [r for r in got if r.held_out]
    truth = np.array([r.doc_id % 10 == 3 for r in test]).astype(int)
    assert _auc(np.array([r.score for r in test]), truth) > 0.98
    flagged = np.array([r.predicted for r in test])
    assert flagged[truth == 1].mean() > 0.85 and flagged[truth == 0].mean() < 0.02


def test_held_out_labels_are_never_learned(spark, toxic_docs):
    docs, labels = toxic_docs
    from pyspark.sql import functions as F
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first = {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in toxicity.toxicity_scores(docs, flipped).collect()}


def test_quality_on_held_out_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.queries()["op9_subword_quality"](spark, sf).collect()
    test = [r for r in got if r.held_out and r.doc_id in labels]
    truth = np.array([labels[r.doc_id] for r in test])
    assert _auc(np.array([r.score for r in test]), truth) > 0.9
    assert np.mean([r.predicted == t for r, t in zip(test, truth, strict=True)]) > 0.9
    assert all(r.predicted == (r.score >= 0.3) for r in got)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("piece", "score")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (3, 1, 0), (3, 0, 1), (4, None, None), (None, 1, 1), (6, 1, 0), (8, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    for run in (quality.quality_scores, toxicity.toxicity_scores):
        got = run(docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out == (r.doc_id is not None and _fold(r.doc_id)) for r in got)
        empty = {r.score for r in got if r.doc_id in (0, 1)}
        assert len(empty) == 1                                    # null and empty score alike
        assert run(no_docs, labels).collect() == []
        assert run(docs, labels.limit(0)).count() == docs.count()
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}


def test_features_do_not_depend_on_neighbours():
    texts = ["", "a", "Hello wide  world", "日本 語\nx", "x" * 5000, "again again again"]
    owner, buckets = features.subword_features(texts)
    w_owner, w_buckets = features.word_features(texts)
    for i, t in enumerate(texts):
        assert sorted(buckets[owner == i]) == sorted(features.subword_features([t])[1])
        assert list(w_buckets[w_owner == i]) == list(features.word_features([t])[1])
    spelled = {f"{t}" for w in " ab ".split() for t in (w,)} | {" ab", "ab ", " ab "}
    assert len(features.subword_features(["ab"])[1]) == len(spelled)
    assert len(features.subword_features(["again again"])[1]) == 2 * len(features.subword_features(["again"])[1]) + 1


def test_table_equals_the_averaged_model():
    r = np.random.default_rng(1)
    docs = [features.subword_features([t])[1].astype(np.int64) for t in ("good words here", "bad!! bad!!", "more good words")]
    model = quality.train(docs, np.array([1, 0, 1]), epochs=30)
    model.bias += r.normal(size=2).astype(np.float32)
    for text, feats in zip(("good words here", "bad!! bad!!"), docs, strict=False):
        logits = model.vectors[feats].mean(axis=0) @ model.layer + model.bias
        p = np.exp(logits[1]) / np.exp(logits).sum()
        assert abs(quality.probabilities([text], *model.table())[0] - p) < 1e-5


def test_risk_offset_cuts_where_the_corrected_risk_is_least():
    positive, unlabelled = np.array([3.0, 4, 5]), np.concatenate([np.full(90, -2.0), np.array([3.5] * 10)])
    assert -3.0 < toxicity.risk_offset(positive, unlabelled, 0.1) < 2.0


def test_training_stays_finite_when_documents_share_their_features():
    """Copies of one short text with both labels and a line that all documents hold: without
    a limit on the step the vectors ran beyond the range of floats and every score was null."""
    rng = np.random.default_rng(4)
    line = rng.integers(0, 1 << features.BITS, 40)
    docs = [np.concatenate([line, rng.integers(k % 2, 1 << features.BITS, 4)]).astype(np.uint32) for k in range(3000)]
    labels = np.array([int(k % 7 != 0) for k in range(3000)])
    model = quality.train(docs, labels)
    table, offset = model.table()
    assert np.isfinite(table).all() and np.isfinite(offset) and np.abs(model.vectors).max() < 1000


def test_an_ordinary_step_is_not_shortened():
    rng = np.random.default_rng(5)
    model = quality.Model(rng.uniform(-1, 1, (64, 4)).astype(np.float32), rng.normal(size=(4, 2)).astype(np.float32), np.zeros(2, np.float32))
    rows, where, sizes = np.repeat([0, 1], 8), np.arange(16), np.array([8, 8])
    assert quality.STEEPEST * quality.step_limit(model, rng.normal(size=(2, 4)), rows, sizes, where, quality.RATE) > 1
