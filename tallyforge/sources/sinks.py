"""Namespaces and table sinks.

Layers (raw, staging, marts, semantic, governance) are catalog databases
created idempotently; a model's configured schema name is used verbatim,
otherwise the target schema. Gold tables are fully rebuilt on each run
(overwrite). The table format is a parameter: parquet by default, ``iceberg``
or ``delta`` where the session has that catalog.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import remove_path

LAYERS = ("raw", "staging", "marts", "semantic", "governance")


def schema_name(custom: str | None, target: str) -> str:
    """A configured schema name verbatim, else the target schema."""
    return custom.strip() if custom and custom.strip() else target


def table_name(layer: str, name: str, custom_schema: str | None = None) -> str:
    return f"{schema_name(custom_schema, layer)}.{name}"


def create_layers(spark: SparkSession, layers=LAYERS, location: str | None = None) -> None:
    """Create the layers' databases, below ``location`` or the session's warehouse."""
    for layer in layers:
        loc = f" LOCATION '{location.rstrip('/')}/{layer}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{loc}")


def write_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: tuple[str, ...] = ()) -> None:
    """Overwrite (full rebuild) a catalog table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def replace_table(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Rebuild a catalog table and read it back.

    The rows are written to a table beside it. Only when that is complete the present
    table is renamed away, the new one takes its name, and then the old one is dropped.
    A build that fails leaves the present table as it is; one that is cut off between the
    renames leaves it under ``<name>__replaced``, from where the next call brings it back.
    """
    spark, beside, old = df.sparkSession, f"{name}__building", f"{name}__replaced"
    restore_table(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {beside}")
    database, _, table = beside.rpartition(".")
    remove_path(spark, f"{spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri}/{table}")     # of a failed build
    write_table(df, beside, fmt)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    except Exception:
        restore_table(spark, name)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)


def restore_table(spark: SparkSession, name: str) -> bool:
    """Bring a table back that an interrupted replacement has renamed away; whether it did."""
    old = f"{name}__replaced"
    if not spark.catalog.tableExists(old):
        return False
    if spark.catalog.tableExists(name):          # the new one is in place: only the drop was cut off
        spark.sql(f"DROP TABLE {old}")
        return False
    spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
    return True
