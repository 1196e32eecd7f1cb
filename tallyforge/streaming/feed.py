"""One change feed for all sources, landed as one table per source.

A feed is a log of ``source, operation, sequence, row``: the name ``schema.table`` of a
source table, what happened to the row (``r`` read by the snapshot, ``c`` created, ``u``
updated, ``d`` deleted), the position in the log and the row as JSON. ``land_feed`` reads
the log as one stream and deals every micro-batch to the tables whose source matches the
include list, a regular expression over whole names; other sources leave nothing.

A landed row has the declared columns of its table and ``_operation``, ``_sequence``;
``_deleted`` is true for a delete, whatever the row says. Columns that a source adds later
are taken over as text behind the declared ones, and rows from before have NULL there.
Rows that are no JSON object are landed in ``_rejected`` with their text.

Row texts repeat their column names in every row, so the log (``append_log``) and the
stored micro-batch are compressed. A micro-batch is stored once, then written per source to ``<out>/<table>/run=<stream
id>/epoch=<n>``; a retried epoch overwrites its own folders, and a log entry delivered
twice is landed twice with one sequence: ``read_table`` keeps one row per sequence.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import DELETED
from ..session import materialize, path_exists
from .changefeed import stream_id

FEED = T.StructType([T.StructField("source", T.StringType()), T.StructField("operation", T.StringType()),
                     T.StructField("sequence", T.LongType()), T.StructField("row", T.StringType())])
REJECTED = "_rejected"
FILE_ROWS = 250_000       # entries of a compressed log file, which one task reads
MAX_ADDED = 1000          # columns a source may add; more is taken for a fault of the feed


def table_of(source: str) -> str:
    """The landing table of a source: its name without the schema, in lower case."""
    return source.rsplit(".", 1)[-1].lower()


def land_feed(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, include: str, schemas: Mapping[str, T.StructType],
              fmt: str = "json", max_files_per_trigger: int | None = None):
    """Land what lies in ``src_dir``; ``schemas`` has the declared columns by table. A later
    call with the same checkpoint goes on; returns the finished query."""
    def fold(batch: DataFrame, epoch: int) -> None:
        run = f"run={stream_id(spark, checkpoint)}/epoch={epoch}"
        wanted = batch.filter(F.col("source").rlike(f"^(?:{include})$"))
        stored = materialize(wanted.withColumn("table", F.lower(F.regexp_extract("source", r"([^.]+)$", 1))), "feed", compression="zstd")
        # names of the tables and of their columns: one aggregate, a row per column of a source
        names = (stored.select("table", F.explode(F.json_object_keys("row")).alias("name")).distinct()
                 .groupBy("table").agg(F.sort_array(F.collect_set("name")).alias("names"), F.count(F.lit(1)).alias("n")))
        found = {r["table"]: r["names"] for r in names.collect()}
        good = F.json_object_keys("row").isNotNull()
        for table, own in found.items():
            declared = schemas.get(table, T.StructType([]))
            added = [c for c in own if c not in declared.fieldNames()]
            if len(added) > MAX_ADDED:
                raise ValueError(f"{table}: the feed adds {len(added)} columns")
            schema = T.StructType([*declared.fields, *(T.StructField(c, T.StringType()) for c in added)])
            rows = stored.filter((F.col("table") == table) & good).select(
                F.from_json("row", schema).alias("r"), F.col("operation").alias("_operation"), F.col("sequence").alias("_sequence"))
            rows = rows.select("r.*", "_operation", "_sequence")
            if DELETED in schema.fieldNames():
                rows = rows.withColumn(DELETED, F.when(F.col("_operation") == "d", F.lit(True)).otherwise(F.col(DELETED)))
            rows.write.mode("overwrite").parquet(f"{out_dir}/{table}/{run}", compression="zstd")
        bad = stored.filter(~good | F.col("row").isNull())
        if bad.limit(1).count():
            bad.drop("table").write.mode("overwrite").parquet(f"{out_dir}/{REJECTED}/{run}")

    reader = spark.readStream.schema(FEED).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (reader.load(src_dir).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_table(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """A landed table, added columns included; one row per sequence number."""
    path = f"{out_dir}/{table}"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no source has landed in {path}")
    rows = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(f"{path}/run=*").drop("run", "epoch")
    twice = rows.groupBy("_sequence").count().filter("count > 1").select("_sequence")
    if not twice.limit(1).count():                     # the usual case: nothing moves
        return rows
    again = rows.join(twice, "_sequence", "left_semi").dropDuplicates(["_sequence"])
    return rows.join(twice, "_sequence", "left_anti").unionByName(again.select(*rows.columns))


def append_log(entries: DataFrame, path: str) -> None:
    """Append feed entries to the log at ``path``: JSON lines, compressed, as rows of JSON
    repeat their column names."""
    entries.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).json(path, compression="gzip")


def to_feed(df: DataFrame, source: str, sequence: str, deleted: str = DELETED) -> DataFrame:
    """Rows of a table as feed entries; ``sequence`` is an SQL expression of the log position."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted in df.columns else F.lit(False)
    return df.select(F.lit(source).alias("source"), F.when(gone, "d").otherwise("c").alias("operation"), F.expr(sequence).cast("long").alias("sequence"),
                     row.alias("row"))
