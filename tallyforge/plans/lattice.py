"""Roll-up lattice: metrics at any dimension set from stored, mergeable states.

``Lattice.build`` passes over the view's base once: it groups by all of the lattice's
dimensions and keeps, per group, the states that the metrics are made of (the sum and the
count of each fact). That finest level is stored, and the coarser levels are made from
it in one aggregate with grouping sets, so the base rows are neither read nor expanded
again. ``query`` answers a dimension set, with a filter on dimensions if wanted, from the
smallest stored level that has them: states are added up, an average is a sum of sums
over a sum of counts, never a mean of means.

A hot group is a few rows per map task before the exchange (partial aggregation). States
are exact for the integer and decimal facts of the views. A set of dimensions outside
the lattice is an error, not a pass over the base. NULL is a dimension value like others.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .semantic import SemanticView

# aggregates that can be put together from states: sum, count, avg of one fact
_AGGREGATE = re.compile(r"\b(sum|count|avg|min|max)\(\s*(\w+)\s*\)", re.IGNORECASE)
_STATES = {"sum": ("sum",), "count": ("count",), "avg": ("sum", "count"), "min": ("min",), "max": ("max",)}
_MERGE = {"sum": "sum", "count": "sum", "min": "min", "max": "max"}


def _states(expr: str) -> list[tuple[str, str]]:
    """The (state, fact) pairs that a metric needs; an error if it needs others."""
    found = [(kind, fact) for name, fact in _AGGREGATE.findall(expr) for kind in _STATES[name.lower()]]
    if not found or re.search(r"[A-Za-z_]\w*\s*\(", _AGGREGATE.sub("", expr)):
        raise ValueError(f"no states for the metric {expr}")
    return found


def _merged(expr: str) -> str:
    """The metric over stored states."""
    def one(m: re.Match) -> str:
        kind, fact = m[1].lower(), m[2]
        if kind == "avg":
            return f"(sum(_sum_{fact}) / sum(_count_{fact}))"
        return f"{_MERGE[kind]}(_{kind}_{fact})"
    return _AGGREGATE.sub(one, expr)


@dataclass
class Lattice:
    spark: SparkSession
    view: SemanticView
    root: str
    dimensions: tuple[str, ...]
    metrics: tuple[str, ...]
    levels: dict[frozenset, tuple[str, int]]       # dimensions -> folder, rows

    @classmethod
    def build(cls, view: SemanticView, root: str, dimensions: Sequence[str], metrics: Sequence[str],
              levels: Sequence[Sequence[str]] | None = None) -> Lattice:
        """Store the finest level over ``dimensions`` and the given coarser ones (all subsets
        if None: keep the dimensions few then)."""
        dims = tuple(view.resolve(d, "dimension").name for d in dimensions)
        mets = tuple(view.resolve(m, "metric").name for m in metrics)
        states = sorted({s for m in mets for s in _states(view.resolve(m, "metric").expr)})
        wanted = [frozenset(view.resolve(d, "dimension").name for d in level) for level in levels] if levels is not None else \
            [frozenset(c) for n in range(len(dims)) for c in itertools.combinations(dims, n)]
        base = view._projected()
        spark = base.sparkSession
        own = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
        base.groupBy(*dims).agg(*(own[k](f).alias(f"_{k}_{f}") for k, f in states)).write.parquet(f"{root}/finest")
        finest = spark.read.parquet(f"{root}/finest")
        stored = {frozenset(dims): (f"{root}/finest", finest.count())}
        coarser = sorted({w for w in wanted if w != frozenset(dims)}, key=sorted)
        if coarser:
            merge = [own[_MERGE[k]](f"_{k}_{f}").alias(f"_{k}_{f}") for k, f in states]
            (finest.groupingSets([tuple(F.col(d) for d in dims if d in w) for w in coarser], *dims)
             .agg(F.grouping_id().alias("level"), *merge).write.partitionBy("level").parquet(f"{root}/coarser"))
            # an empty base has a finest level without rows and nothing else
            rows = {r["level"]: r["count"] for r in spark.read.parquet(f"{root}/coarser").groupBy("level").count().collect()} \
                if stored[frozenset(dims)][1] else {}                                                            # a row per level
            for w in coarser if rows else []:
                level = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in w)
                stored[w] = (f"{root}/coarser/level={level}", rows[level])
        return cls(spark, view, root, dims, mets, stored)

    def level_of(self, names: frozenset) -> str:
        """The folder of the smallest stored level that has the dimensions."""
        fitting = [(rows, len(dims), folder) for dims, (folder, rows) in self.levels.items() if names <= dims]
        if not fitting:
            raise KeyError(f"{sorted(names - set(self.dimensions))} are not in the lattice")
        return min(fitting)[2]

    def query(self, dimensions: Sequence[str] = (), metrics: Sequence[str] = (), where: dict[str, Sequence] | None = None) -> DataFrame:
        """Metrics by dimensions; ``where`` keeps the given values of a dimension."""
        dims = [self.view.resolve(d, "dimension").name for d in dimensions]
        mets = [self.view.resolve(m, "metric") for m in metrics]
        if unknown := [m.name for m in mets if m.name not in self.metrics]:
            raise KeyError(f"{unknown} are not in the lattice")
        kept = {self.view.resolve(d, "dimension").name: list(values) for d, values in (where or {}).items()}
        states = self.spark.read.parquet(self.level_of(frozenset([*dims, *kept])))
        for name, values in kept.items():
            states = states.filter(_among(F.col(name), values))
        return states.groupBy(*dims).agg(*(F.expr(_merged(m.expr)).alias(m.name) for m in mets))


def _among(c: Column, values: list) -> Column:
    some = c.isin([v for v in values if v is not None])
    return some | c.isNull() if None in values else F.coalesce(some, F.lit(False))
