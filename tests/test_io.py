import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import search
from tallyforge.sources import documents, sinks
from tallyforge.streaming import documents as docstream


def test_land_documents_truncate_and_load(spark, scratch):
    stage = spark.createDataFrame([("EARNINGS_SYM001_2026Q1.pdf", "a"), ("b.txt", "b")], "file_name string, content string")
    documents.land_documents(stage, f"{scratch}/raw")
    documents.land_documents(stage, f"{scratch}/raw")   # reload replaces, never appends
    rows = spark.read.parquet(f"{scratch}/raw").collect()
    assert [(r["file_name"], r["symbol"], r["parsed_text"]) for r in rows] == [("EARNINGS_SYM001_2026Q1.pdf", "SYM001", "a")]


def _docs(spark, rows):
    return documents.document_keys(spark.createDataFrame(
        [(p, p.rsplit("/", 1)[-1], t, dt.datetime(2026, 1, v)) for p, t, v in rows],
        "path string, file_name string, parsed_text string, modified_at timestamp"))


def test_refresh_index_counts_every_document_once(spark, scratch):
    """New, changed and re-delivered documents: the index answers as one built afresh."""
    index = f"{scratch}/index"
    first = [("a/EARNINGS_SYM001_2026Q1.pdf", "weak demand and cutting guidance", 1),
             ("a/EARNINGS_SYM002_2026Q1.pdf", "strong demand, raising guidance", 1)]
    later = [("a/EARNINGS_SYM001_2026Q1.pdf", "weak weak margins", 2), ("b/EARNINGS_SYM001_2026Q1.pdf", "guidance is weak", 2)]
    cols = ("modified_at", "file_name", "symbol", "fiscal_period")
    assert docstream.refresh_index(spark, _docs(spark, first), index, cols) == 2
    assert docstream.refresh_index(spark, _docs(spark, first), index, cols) == 0         # delivered again
    now = [later[0], first[1], later[1]]
    assert docstream.refresh_index(spark, _docs(spark, now), index, cols) == 2
    queries = spark.createDataFrame([(1, "weak guidance")], "query_id long, text string")
    got = search.bm25_topk_index(docstream.read_index(spark, index), queries, k=3, columns=("file_name", "symbol"))
    exp = search.bm25_topk(_docs(spark, now), queries, k=3, id_col="path", text_col="parsed_text", columns=("file_name", "symbol"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect())) and got.count() == 3
    only = search.bm25_topk_index(docstream.read_index(spark, index), queries, k=3, filters="symbol = 'SYM002'", columns=("symbol",))
    assert [r.symbol for r in only.collect()] == ["SYM002"]


def test_search_results_json_roundtrip(spark):
    top = spark.createDataFrame([(1, 2, "SYM2", "negative"), (1, 1, "SYM1", "mixed"), (2, 1, "SYM3", None)],
                                "query_id long, rank int, symbol string, sentiment string")
    js = search.results_json(top, ["symbol", "sentiment"])
    doc = {r["query_id"]: r["json"] for r in js.collect()}
    assert doc[1] == '{"results":[{"symbol":"SYM1","sentiment":"mixed"},{"symbol":"SYM2","sentiment":"negative"}]}'
    flat = search.flatten_results(js, "symbol string, sentiment string")
    assert sorted(tuple(r) for r in flat.collect()) == [(1, "SYM1", "mixed"), (1, "SYM2", "negative"), (2, "SYM3", None)]


def test_layers_and_table_sink(spark, scratch):
    sinks.create_layers(spark, location=scratch)
    sinks.create_layers(spark, location=scratch)            # idempotent
    assert {"raw", "staging", "marts", "semantic", "governance"} <= {d.name for d in spark.catalog.listDatabases()}
    name = sinks.table_name("marts", "t_demo")
    df = spark.createDataFrame([(1,)], "x int")
    sinks.write_table(df, name)
    sinks.write_table(df.union(df), name)                     # full rebuild
    assert spark.table(name).count() == 2
    assert sinks.schema_name("  custom ", "marts") == "custom" and sinks.schema_name(None, "marts") == "marts"
    assert os.path.isdir(os.path.join(scratch, "marts.db"))


def test_variant_path_access_on_results(spark):
    top = spark.createDataFrame([(1, 1, "SYM1", "mixed"), (1, 2, "SYM2", "negative")],
                                "query_id long, rank int, symbol string, sentiment string")
    js = search.results_json(top, ["symbol", "sentiment"])
    v = js.select(F.parse_json("json").alias("v"))
    got = v.select(F.variant_get("v", "$.results[1].symbol", "string").alias("s"),
                   F.variant_get("v", "$.results[0].sentiment", "string").alias("t")).first()
    assert (got["s"], got["t"]) == ("SYM2", "mixed")


def test_replaced_table_survives_a_failed_build(spark, scratch):
    sinks.create_layers(spark, ("kept",), scratch)
    assert sinks.replace_table(spark.createDataFrame([(1,)], "x int"), "kept.t").count() == 1
    assert sinks.replace_table(spark.createDataFrame([(1,), (2,)], "x int"), "kept.t").count() == 2
    with pytest.raises(Exception, match="no such row"):
        sinks.replace_table(spark.range(3).selectExpr("raise_error('no such row') AS x"), "kept.t")
    assert spark.table("kept.t").count() == 2
    assert sinks.replace_table(spark.createDataFrame([(7,)], "x int"), "kept.t").first()["x"] == 7


def test_replacement_cut_off_between_the_renames_is_brought_back(spark, scratch):
    sinks.create_layers(spark, ("cut_off",), scratch)
    sinks.replace_table(spark.createDataFrame([(1,)], "x int"), "cut_off.t")
    spark.sql("ALTER TABLE cut_off.t RENAME TO cut_off.t__replaced")             # where a crash may leave it
    assert sinks.restore_table(spark, "cut_off.t") and spark.table("cut_off.t").first()["x"] == 1
    spark.sql("ALTER TABLE cut_off.t RENAME TO cut_off.t__replaced")
    with pytest.raises(Exception, match="no such row"):
        sinks.replace_table(spark.range(3).selectExpr("raise_error('no such row') AS x"), "cut_off.t")
    assert spark.table("cut_off.t").first()["x"] == 1
    assert sinks.replace_table(spark.createDataFrame([(2,)], "x int"), "cut_off.t").first()["x"] == 2
    assert not spark.catalog.tableExists("cut_off.t__replaced")
