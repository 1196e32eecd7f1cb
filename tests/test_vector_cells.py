import numpy as np
import pytest

from tallyforge.operators import search, vector_cells
from tallyforge.operators.vector_cells import VectorCells
from tallyforge.sources import adapter


def clustered(seed, n, dim, centres):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return (middle[rng.integers(0, centres, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)


def test_every_row_has_a_cell_and_all_probes_are_exact(spark, scratch, monkeypatch):
    monkeypatch.setattr(vector_cells, "CHUNK_ROWS", 40)
    monkeypatch.setattr(vector_cells, "BLOCK_QUERIES", 6)
    rows = [(f"v{i:03d}", v.tolist()) for i, v in enumerate(clustered(1, 300, 8, 12))]
    rows += [(f"same{i}", rows[0][1]) for i in range(150)]                       # a third of all rows is one vector
    odd = [("null", None), ("zero", [0.0] * 8), ("nan", [float("nan")] * 8), ("short", [1.0]), ("empty", [])]
    corpus = spark.createDataFrame(rows + odd, "vec_id string, embedding array<float>").repartition(4)
    cells = VectorCells.build(corpus, f"{scratch}/cells", cells=15)
    assert sum(cells.counts.values()) == 450 and len(cells.counts) > 5 and 1 <= cells.probes <= 15
    queries = spark.createDataFrame([(i, rows[i * 7][1]) for i in range(30)] + [(90, None), (91, [0.0] * 8)], "query_id long, embedding array<float>")
    exact = sorted(map(tuple, search.cosine_topk(spark.createDataFrame(rows, corpus.schema), queries, 5).collect()))
    assert sorted(map(tuple, cells.search(queries, 5, probes=99).collect())) == exact
    assert sorted(map(tuple, VectorCells.load(spark, f"{scratch}/cells").search(queries, 5).collect())) == sorted(map(tuple, cells.search(queries, 5).collect()))
    plan = cells.rows_of([3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part#" in plan or "PartitionFilters: [part#" in plan


def test_recall_on_the_given_vectors(spark, scratch):
    """At least 0.9 of the exact neighbours, with some of the cells left unread."""
    emb = adapter.read_table(spark, "/root/testdata/sf0.001", "embeddings")
    queries = emb.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding")
    cells = VectorCells.build(emb, f"{scratch}/given", k=5)
    assert cells.recall(emb, queries, 5) >= 0.9
    own = VectorCells.build(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(clustered(5, 2000, 16, 40))],
                                                  "vec_id long, embedding array<float>"), f"{scratch}/clustered", k=5)
    assert own.probes <= 0.3 * len(own.centres)


def test_empty_corpus(spark, scratch):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    cells = VectorCells.build(none, f"{scratch}/none")
    assert cells.search(spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<float>"), 3).collect() == []


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_rows_than_cells(spark, scratch, n):
    rows = [(i, [float(i + 1), 1.0]) for i in range(n)]
    corpus = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    cells = VectorCells.build(corpus, f"{scratch}/few", cells=9)
    got = cells.search(corpus.withColumnRenamed("vec_id", "query_id"), 1, probes=9).collect()
    assert sorted(r["vec_id"] for r in got) == list(range(n))
