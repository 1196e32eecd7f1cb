"""Object lineage: edges between sources, models and serving objects, and
bounded upstream / downstream traversal returning edges with their distance.

Edges come from the model dependency list (plans.build.DEPENDS_ON) plus the
source of each silver model and the base of each serving object, so they
follow the code rather than a hand-kept list. Traversal is an iterative
frontier join over the edge DataFrame, one join per distance step (the depth
is a parameter, not data-dependent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The landing source of each silver model and the base of each
# serving object.
SILVER_SOURCES = {
    "stg_customers": "customers",
    "stg_instrument_prices": "instrument_prices",
    "stg_transactions": "transactions",
    "stg_trades": "trades",
    "stg_risk_metrics": "risk_metrics",
    "stg_earnings_transcripts": "transcripts_raw",
}
LANDING_SOURCES = {"transcripts_raw": "doc_stage"}
SERVING = {
    "investor_360_sv": "investor_360",
    "portfolio_risk_sv": "portfolio_risk",
    "earnings_search": "stg_earnings_transcripts",
}


def model_edges() -> list[tuple[str, str]]:
    from ..plans.build import DEPENDS_ON
    edges = [(src, tgt) for tgt, src in LANDING_SOURCES.items()]
    edges += [(src, tgt) for tgt, src in SILVER_SOURCES.items()]
    edges += [(up, tgt) for tgt, ups in DEPENDS_ON.items() for up in ups]
    edges += [(base, tgt) for tgt, base in SERVING.items()]
    return edges


def lineage_edges(spark: SparkSession, edges: list[tuple[str, str]] | None = None) -> DataFrame:
    return spark.createDataFrame(edges or model_edges(), "source string, target string")


def _walk(edges: DataFrame, obj: str, max_distance: int, upstream: bool) -> DataFrame:
    near, far = ("target", "source") if upstream else ("source", "target")
    frontier = edges.filter(F.col(near) == obj).withColumn("distance", F.lit(1))
    found = frontier
    for d in range(2, max_distance + 1):
        nxt = (frontier.select(F.col(far).alias("_hop")).distinct()
               .join(edges, F.col("_hop") == F.col(near)).drop("_hop")
               .withColumn("distance", F.lit(d)))
        found = found.unionByName(nxt)
        frontier = nxt
    return found.select("source", "target", "distance").distinct()


def upstream(edges: DataFrame, obj: str, max_distance: int = 3) -> DataFrame:
    """Edges on paths ending at ``obj``, with their distance from it."""
    return _walk(edges, obj, max_distance, upstream=True).orderBy("distance", "source", "target")


def downstream(edges: DataFrame, obj: str, max_distance: int = 3) -> DataFrame:
    """Edges on paths starting at ``obj``, with their distance from it."""
    return _walk(edges, obj, max_distance, upstream=False).orderBy("distance", "target", "source")
