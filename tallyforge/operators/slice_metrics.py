"""Metric runs that measure only the slices of a table that changed.

The table is a Parquet folder with one partition column, the slice. A run compares each
slice's files (names, times and sizes, from a listing) with those of the run before and
measures only slices that are new or differ: counts are one number per slice and metric,
and for duplicate counts the slice's keys are kept with how often each occurs, dealt into
buckets by a hash. Everything else comes from the kept states: counts add up, and a
key's occurrences add up over slices, so duplicates across slices are found exactly
without reading the slices again. A slice that is gone leaves the totals.

A run's states lie in a folder of their own; the run counts once its line is in the
manifest (one file, written last). Results are appended to the history with their time,
as ``quality.append_results`` does for whole measurements; the totals equal those of
``quality.metrics`` over the whole table (tested). NULL keys count as one value.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from .quality import Metric, _metric_expr, append_results

KEY_BUCKETS = 64


def _listed(spark: SparkSession, path: str, slice_col: str) -> dict[str, str]:
    """A digest of the files of each slice; no file is opened. A row per slice comes back."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
             .select(F.regexp_extract("path", rf"/{slice_col}=([^/]*)/", 1).alias("slice"),
                     F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)").alias("h")))
    return {r["slice"]: f"{r['n']}:{r['h']}" for r in files.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("h")).collect()}


def _manifest(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """slice -> [digest of its files, run that measured it] of the newest complete run."""
    if not path_exists(spark, f"{root}/manifest"):
        return {}
    newest = spark.read.schema("at string, slices string").json(f"{root}/manifest").orderBy(F.col("at").desc()).first()
    return json.loads(newest["slices"]) if newest else {}


def measure(spark: SparkSession, path: str, slice_col: str, specs: Sequence[Metric], table: str, root: str,
            measured_at: dt.datetime | None = None) -> tuple[DataFrame, list[str]]:
    """Measure what changed, append the totals to ``<root>/history`` and return them
    (table, metric, column, value) with the slices that were read."""
    measured_at = measured_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    known, now = _manifest(spark, root), _listed(spark, path, slice_col)
    changed = sorted(s for s, digest in now.items() if known.get(s, [None])[0] != digest)
    run = uuid.uuid4().hex
    counts = [(i, m) for i, m in enumerate(specs) if m.kind != "duplicate_count"]
    keys = [(i, m) for i, m in enumerate(specs) if m.kind == "duplicate_count"]
    if changed:
        rows = changed_rows(spark, path, slice_col, changed)
        agg = rows.groupBy("_slice").agg(*(_metric_expr(m).cast("long").alias(f"m{i}") for i, m in counts), F.count(F.lit(1)).alias("_rows"))
        agg.withColumn("run", F.lit(run)).write.mode("append").partitionBy("run").parquet(f"{root}/counts")
        for i, m in keys:
            c = F.col(m.column).cast("string")
            (rows.groupBy("_slice", c.alias("key")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(KEY_BUCKETS)).cast("int")).withColumn("run", F.lit(run)).withColumn("metric", F.lit(i))
             .write.mode("append").partitionBy("metric", "run").parquet(f"{root}/keys"))
    held = {s: [d, run] if s in changed else known[s] for s, d in now.items()}
    spark.createDataFrame([(f"{measured_at.isoformat()}/{run}", json.dumps(held))], "at string, slices string").coalesce(1).write.mode("append").json(f"{root}/manifest")
    totals = _totals(spark, held, counts, keys, table, root)
    append_results(totals, f"{root}/history", measured_at)
    return totals, changed


def changed_rows(spark: SparkSession, path: str, slice_col: str, changed: Sequence[str]) -> DataFrame:
    """The rows of some slices; the others' folders are not opened."""
    text = F.coalesce(F.col(slice_col).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
    return spark.read.parquet(path).filter(text.isin(list(changed))).withColumn("_slice", text)


def _totals(spark, held, counts, keys, table, root) -> DataFrame:
    schema = "table string, metric string, column string, value long"
    if not held:
        rows = [(table, m.name, m.column, 0) for _, m in sorted(counts + keys)]
        return spark.createDataFrame(rows, schema)
    valid = spark.createDataFrame([(s, r) for s, (_, r) in held.items()], "_slice string, run string")      # a row per slice
    out = None

    def add(df: DataFrame, m: Metric) -> None:
        nonlocal out
        row = df.select(F.lit(table).alias("table"), F.lit(m.name).alias("metric"), F.lit(m.column).cast("string").alias("column"), F.col("value").cast("long"))
        out = row if out is None else out.unionByName(row)

    if counts:
        sums = spark.read.parquet(f"{root}/counts").join(valid, ["_slice", "run"], "left_semi").agg(*(F.coalesce(F.sum(f"m{i}"), F.lit(0)).alias(f"m{i}") for i, _ in counts))
        for i, m in counts:
            add(sums.select(F.col(f"m{i}").alias("value")), m)
    for i, m in keys:
        state = spark.read.parquet(f"{root}/keys").filter(F.col("metric") == i).join(valid, ["_slice", "run"], "left_semi")
        per_key = state.groupBy("bucket", "key").agg((F.sum("n") - 1).alias("more"))
        add(per_key.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("value")), m)
    return out
