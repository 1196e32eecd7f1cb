"""Connected components of a link table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame, store: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """(id, component) of every id in ``links`` (columns a, b): the least id reachable.

    Labels start as the least neighbour; each round takes the least label among
    the neighbours and then jumps to that label's own label, so the rounds grow
    with the logarithm of the longest chain. Every round is written out: nothing
    is collected and a lost executor costs one round at most. Centres of large
    stars are hot on one side of the joins only, which the skew join splits.
    """
    both = store(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = store(both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels")
    while True:
        nearest = (both.join(labels, both.b == labels.id).groupBy(F.col("a").alias("near_id")).agg(F.min("component").alias("near")))
        step = store(labels.join(nearest, F.col("id") == F.col("near_id")).select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")), "labels")
        target = step.select(F.col("id").alias("target"), F.col("component").alias("beyond"))
        new = store(step.join(target, F.col("component") == F.col("target")).select(
            "id", F.least("component", "beyond").alias("component"), (F.col("beyond") < F.col("old")).alias("changed")), "labels")
        labels = new.drop("changed")
        if new.filter("changed").isEmpty():
            return labels
