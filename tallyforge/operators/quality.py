"""Data tests that gate a build, and data-quality metrics.

A test is a query for failing rows; zero failures = pass. ``failures``
follows the usual generic-test definitions:

* not_null(c)                 rows where c is NULL
* unique(c)                   distinct non-NULL values of c that occur more than once
* accepted_values(c, vs, w)   distinct non-NULL values of c outside vs (rows filtered by w)
* relationships(c, to, f)     non-NULL child rows whose c has no parent row with f = c

Execution: all tests of one model run in ONE pass over the model: every row
emits ``(test, value)`` pairs only for what the tests need (a NULL marker, an
invalid value, or the key of a uniqueness or relationship test), and a single
``groupBy(test, value)`` with map-side partial aggregation counts them. A value
that holds a third of all rows is reduced per map task before the shuffle; no
value list is ever collected into one task. The parents' distinct keys then
meet these counts in one left join, and one last aggregate per test gives all
kinds of failures together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("model", "test", "column", "failures")


@dataclass(frozen=True)
class DataTest:
    kind: str                       # not_null | unique | accepted_values | relationships
    column: str
    values: tuple = ()
    where: str | None = None
    to: str | None = None           # parent model
    field: str | None = None        # parent column
    severity: str = "error"         # error gates dependants; warn only reports


def not_null(column: str, severity: str = "error") -> DataTest:
    return DataTest("not_null", column, severity=severity)


def unique(column: str, severity: str = "error") -> DataTest:
    return DataTest("unique", column, severity=severity)


def accepted_values(column: str, values: Sequence, where: str | None = None, severity: str = "error") -> DataTest:
    return DataTest("accepted_values", column, tuple(values), where=where, severity=severity)


def relationships(column: str, to: str, field: str, severity: str = "error") -> DataTest:
    return DataTest("relationships", column, to=to, field=field, severity=severity)


def _is_long(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long")


def _fused(model: str, df: DataFrame, specs: Sequence[DataTest],
           parents: Mapping[str, DataFrame]) -> DataFrame | None:
    """All tests of one model from one pass over it and one shuffle of test values."""
    if not specs:
        return None
    # integer keys stay integers on their way; everything else travels as text
    native = [t.kind in ("unique", "relationships") and _is_long(df, t.column)
              and (t.to is None or _is_long(parents[t.to], t.field)) for t in specs]
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    emits = []
    for i, t in enumerate(specs):
        c = F.col(t.column)
        if t.kind == "not_null":
            cond, val = c.isNull(), F.lit("")
        elif t.kind in ("unique", "relationships"):
            cond, val = c.isNotNull(), c.cast("string")
        else:
            cond = c.isNotNull() & ~c.isin(*t.values)
            if t.where:
                cond = cond & F.coalesce(F.expr(t.where), F.lit(False))
            val = c.cast("string")
        emits.append(F.when(cond, F.struct(F.lit(i).alias("tid"), (c.cast("long") if native[i] else number).alias("l"),
                                           (text if native[i] else val).alias("v"))))
    # empty places are dropped behind the explode, in generated code: a function over the
    # array would be evaluated row by row
    pairs = df.select(F.explode(F.array(*emits)).alias("e")).filter("e IS NOT NULL").select("e.tid", "e.l", "e.v")
    # distinct (test, value) with their row counts; partial aggregation per task
    counted = pairs.groupBy("tid", "l", "v").agg(F.count(F.lit(1)).alias("n"))
    linked = [i for i, t in enumerate(specs) if t.kind == "relationships"]
    known = F.lit(False)
    if linked:
        # parent keys meet the counts on (test, value), by which the counts already lie
        keys = None
        for i in linked:
            c = F.col(specs[i].field)
            own = parents[specs[i].to].filter(c.isNotNull()).select(
                F.lit(i).alias("ptid"), (c.cast("long") if native[i] else number).alias("pl"),
                (text if native[i] else c.cast("string")).alias("pv")).distinct()
            keys = own if keys is None else keys.unionByName(own)
        counted = counted.join(keys, (F.col("tid") == F.col("ptid")) & F.col("l").eqNullSafe(F.col("pl"))
                               & F.col("v").eqNullSafe(F.col("pv")), "left")
        known = F.col("ptid").isNotNull()
    kinds = F.create_map(*[x for i, t in enumerate(specs) for x in (F.lit(i), F.lit(t.kind))])
    kind, n = F.element_at(kinds, F.col("tid")), F.col("n")
    zero = F.lit(0).cast("long")
    per_test = counted.groupBy("tid").agg(
        F.sum(F.when(kind == "not_null", n)
               .when(kind == "unique", (n > 1).cast("long"))
               .when(kind == "relationships", F.when(known, zero).otherwise(n))
               .otherwise(F.lit(1).cast("long"))).alias("failures"))
    spec_rows = df.sparkSession.createDataFrame(
        [(i, model, t.kind, t.column) for i, t in enumerate(specs)],
        "tid int, model string, test string, column string")
    # per_test has at most one row per declared test: a proven bound
    return (spec_rows.join(F.broadcast(per_test), "tid", "left")
                     .select("model", "test", "column",
                             F.coalesce(F.col("failures"), F.lit(0).cast("long")).alias("failures")))


def run_tests(models: Mapping[str, DataFrame], specs: Mapping[str, Sequence[DataTest]]) -> DataFrame:
    """``DataFrame[model, test, column, failures]`` for every spec (lazy)."""
    parts = [p for model, tests in specs.items()
             if (p := _fused(model, models[model], tests, models)) is not None]
    if not parts:
        spark = next(iter(models.values())).sparkSession
        return spark.createDataFrame([], "model string, test string, column string, failures long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ metrics

@dataclass(frozen=True)
class Metric:
    name: str
    kind: str                       # row_count | null_count | duplicate_count | custom
    column: str | None = None
    expr: Column | str | None = None  # custom: boolean Column or SQL expression, counted where true


def row_count(name: str = "row_count") -> Metric:
    return Metric(name, "row_count")


def null_count(column: str, name: str | None = None) -> Metric:
    return Metric(name or f"null_{column}", "null_count", column)


def duplicate_count(column: str, name: str | None = None) -> Metric:
    """Rows minus distinct values, NULL counting as one value."""
    return Metric(name or f"dup_{column}", "duplicate_count", column)


def count_where(name: str, condition: Column | str, column: str | None = None) -> Metric:
    """Custom rule: number of rows where ``condition`` (Column or SQL text) holds."""
    return Metric(name, "custom", column, condition)


def _metric_expr(m: Metric) -> Column:
    if m.kind == "row_count":
        return F.count(F.lit(1))
    if m.kind == "null_count":
        return F.count_if(F.col(m.column).isNull())
    if m.kind == "duplicate_count":
        c = F.col(m.column)
        some_null = F.coalesce(F.max(c.isNull().cast("int")).cast("long"), F.lit(0))     # an empty table has none
        return F.count(F.lit(1)) - F.count_distinct(c) - some_null
    return F.count_if(F.expr(m.expr) if isinstance(m.expr, str) else m.expr)


def metrics(df: DataFrame, specs: Sequence[Metric], table: str) -> DataFrame:
    """``DataFrame[table, metric, column, value]``: one aggregate pass, then unpivot."""
    agg = df.agg(*[_metric_expr(m).cast("long").alias(f"m{i}") for i, m in enumerate(specs)])
    rows = F.explode(F.array(*[F.struct(F.lit(m.name).alias("metric"),
                                        F.lit(m.column).cast("string").alias("column"),
                                        F.col(f"m{i}").alias("value")) for i, m in enumerate(specs)]))
    return agg.select(rows.alias("r")).select(F.lit(table).alias("table"), "r.metric", "r.column", "r.value")


def append_results(results: DataFrame, path: str, measured_at: dt.datetime | None = None,
                   fmt: str = "parquet") -> None:
    """Append metric rows with a measurement timestamp (results accumulate)."""
    ts = F.lit((measured_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).isoformat(sep=" "))
    results.withColumn("measured_at", ts.cast("timestamp_ntz")).write.mode("append").format(fmt).save(path)
