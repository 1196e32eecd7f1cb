"""Small operational reports: landing row counts and referential orphans."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``DataFrame[t, n]``: one count per table, unioned (each count is a
    global aggregate with partial counts per task)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("t"), "n")
             for name, df in tables.items()]
    if not parts:
        raise ValueError("row_counts needs at least one table")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None,
            distinct: bool = False) -> DataFrame:
    """Child rows with a non-NULL key that has no parent row (anti-join).
    ``distinct=True`` lists each orphan key once."""
    pk = parent_key or key
    p = parent.select(F.col(pk).alias("_pk")).filter(F.col("_pk").isNotNull()).distinct()
    c = child.filter(F.col(key).isNotNull())
    out = c.join(p, c[key] == p["_pk"], "left_anti")
    return out.select(key).distinct() if distinct else out
