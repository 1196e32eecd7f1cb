import public_tokenizers as P
import pytest
import test_decontamination
import test_neardup
import test_packing
from tokenizers import Tokenizer

import corpus_pipeline
from tallyforge.llm import pii, quality
from tallyforge.session import materialize

STAGES = dict(corpus_pipeline.STAGES)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    """The small table with a column that clashes, a null id, a null text, an empty one and repeated rows."""
    from pyspark.sql import functions as F
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("kept", F.lit("mine"))
    extra = spark.createDataFrame([(None, "no id here but some words to read", "en", "s", 1, "x"), (9001, None, "en", "s", 0, "x"),
                                   (9002, "", None, None, None, "x")] + 2 * [(9003, "said twice, id and all, in just these words", "en", "s", 43, "x")],
                                  given.schema)
    return materialize(given.unionByName(extra), "pipeline-test")


def test_stage_names_and_order():
    assert list(STAGES) == ["quality_classifier", "near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]


def test_quality_stage(spark, docs, sf):
    got = STAGES["quality_classifier"](spark, docs, sf)
    assert got.columns == docs.columns
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    want = [r for r in docs.collect() if quality.probabilities([r.text or ""], *model.table())[0] >= quality.THRESHOLD]
    assert _rows(got) == sorted(map(tuple, want), key=repr) and len(want) < docs.count()


def test_near_dedup_stage(spark, docs, sf):
    got = STAGES["near_dedup"](spark, docs, sf)
    assert got.columns == docs.columns
    rows = docs.collect()
    component = test_neardup.brute_force([(r.doc_id, r.text) for r in rows if r.doc_id is not None])
    want = {tuple(r) for r in rows if r.doc_id is None or component[r.doc_id] == r.doc_id}
    assert _rows(got) == sorted(want, key=repr) and len(want) < len(rows)


def test_decontamination_stage(spark, docs, sf):
    got = STAGES["benchmark_decontamination"](spark, docs, sf)
    assert got.columns == docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {d for d, _ in test_decontamination.brute_force([(r.doc_id, r.text) for r in docs.collect()], items)}
    assert _rows(got) == sorted((tuple(r) for r in docs.collect() if r.doc_id not in leaks), key=repr) and leaks


def test_pii_stage(spark, docs, sf):
    got = STAGES["pii"](spark, docs, sf)
    assert got.schema == docs.schema
    finder = pii.Finder(pii.fit(docs))
    want = []
    for r in docs.collect():
        text = r.text
        if text is not None:
            base, added = finder.find([text])[0]
            text = pii.redact_text(text, [*base, *added])
            assert not base or not pii.base_spans(text)
        want.append((r.doc_id, text, r.lang, r.source, None if text is None else len(text), r.kept))
    assert _rows(got) == sorted(want, key=repr)
    assert any("<EMAIL>" in (w[1] or "") or "<IP>" in (w[1] or "") for w in want)


def test_packing_stage(spark, docs, sf):
    rows = {r.doc_id: r.text for r in docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).collect()}
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {d: tok.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows.items()}
    test_packing._check(STAGES["best_fit_packing"](spark, docs.filter("doc_id is not null").dropDuplicates(["doc_id"]), sf).collect(), want)


def test_stages_take_empty_tables_and_run_equals_them(spark, docs, sf):
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, sf)
        assert out.columns == docs.columns and out.collect() == [], name
    assert STAGES["best_fit_packing"](spark, empty, sf).collect() == []
    step = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        step = materialize(stage(spark, step, sf), f"test-{name}")
    assert _rows(corpus_pipeline.run(spark, sf)) == _rows(step)
