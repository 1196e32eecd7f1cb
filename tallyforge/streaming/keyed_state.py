"""Change apply with keyed stream state: only changes of the live table come out.

The state store of the stream holds, per key, the order of the newest version seen, a
digest that breaks ties and whether that version is a tombstone: three fixed-width
fields, however wide the rows are. Keys are dealt by their hash to ``buckets`` groups; a
group keeps its keys in one Arrow table and meets a micro-batch in column operations, so
no key costs a Python call. The number of buckets belongs to the checkpoint, as the number
of shuffle partitions does; a micro-batch rewrites the tables of the buckets it touches.
A micro-batch's newest row per key is compared with the state and comes out as ``insert``, ``update`` or ``delete`` if it changes the live table; a
late or repeated version comes out as nothing. So a consumer reads changes instead of
folding all versions again, and any batching in any order ends with the same table.

Order columns are timestamps, dates or integers, compared in turn, NULL lowest; exact
ties of all of them go to the greater digest of the row. State grows with the number of
keys (tombstones stay, or an older version arriving late would bring a deleted key back),
and lives in the stream's checkpoint: a restart goes on from it. Rows of a hot key are
reduced to one per Arrow batch before they are shuffled.

``apply_stream`` writes each micro-batch's changes to ``<out>/run=<stream id>/epoch=<n>``;
a retried epoch overwrites its own folder. ``live_table`` is the newest change per key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import DELETED, is_live, latest_by_key
from .changefeed import _epochs, stream_id

CHANGE = "_change"
BUCKETS = 1024           # groups of keys in the state store
_NULL = -(1 << 63)


def _order(df: DataFrame, column: str) -> Column:
    """A long that orders like the column, NULL lowest."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast(kind), c)
    elif isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"order column {column} is neither a time nor an integer")
    return F.coalesce(c.cast("long"), F.lit(_NULL))


def changes_of(stream: DataFrame, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """The changes of the live table: the columns of ``stream`` and ``_change``."""
    keys, order = list(keys), list(order)
    columns = stream.columns
    ranks = [f"_o{i}" for i in range(len(order))]
    marked = stream.withColumns({r: _order(stream, c) for r, c in zip(ranks, order)})
    marked = marked.withColumns({"_tie": F.xxhash64(*columns), "_gone": ~is_live() if DELETED in columns else F.lit(False)})
    by = [*ranks, "_tie"]

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*stream.schema.fields, T.StructField(CHANGE, T.StringType())])
    marked = marked.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def newest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The newest row per key of a batch, packed: a row per bucket."""
        for batch in batches:
            kept = batch.take(pa.array(_newest_rows(batch, keys, by)))
            bucket = kept.column("_bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            kept, bucket = kept.take(pa.array(order)).drop_columns(["_bucket"]), bucket[order]
            start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, int)
            packed = [_pack(kept.slice(i, n)) for i, n in zip(start.tolist(), np.diff(start, append=len(bucket)).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[start], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "rows"])

    def step(key, frames, held):
        rows = pa.concat_tables(_unpack(x) for frame in frames for x in frame["rows"]).combine_chunks()
        rows = rows.take(pa.array(_newest_rows(rows, keys, by)))
        fields = [*keys, *by, "_gone"]
        known = _unpack(held.get[0]) if held.exists else rows.select(fields).slice(0, 0)
        code = _codes(pa.concat_tables([known.select(keys), rows.select(keys)]), keys)
        old, new = code[:len(known)], code[len(known):]
        at = np.full(code.max(initial=-1) + 1, -1)                        # where the state has a key
        at[old] = np.arange(len(old))
        place = at[new]
        held_before, later, equal = place >= 0, np.zeros(len(new), bool), np.ones(len(new), bool)
        for c in by:
            fresh, seen = rows.column(c).to_numpy(), np.append(known.column(c).to_numpy(), 0)[place]
            later, equal = later | (equal & (fresh > seen)), equal & (fresh == seen)
        taken = ~held_before | later
        gone = rows.column("_gone").to_numpy()
        was = held_before & ~np.append(known.column("_gone").to_numpy(), True)[place]
        if not taken.any():
            return
        stays = np.ones(len(old), bool)
        stays[place[held_before & taken]] = False
        held.update((_pack(pa.concat_tables([known.filter(pa.array(stays)), rows.select(fields).filter(pa.array(taken))])),))
        kind = np.where(gone, np.where(was, "delete", ""), np.where(was, "update", "insert"))
        out = taken & (kind != "")
        if out.any():
            changed = rows.select(columns).filter(pa.array(out)).append_column(CHANGE, pa.array(kind[out].tolist(), pa.string()))
            yield pd.DataFrame({"rows": [_pack(changed)]})

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("rows").to_pylist():
                yield from _unpack(packed).to_batches()

    packed = T.StructType([T.StructField("rows", T.BinaryType())])
    return (marked.mapInArrow(newest, "bucket int, rows binary").groupBy("bucket")
            .applyInPandasWithState(step, packed, packed, "append", "NoTimeout").mapInArrow(rows_of, ddl))


def _pack(rows: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return sink.getvalue().to_pybytes()


def _unpack(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(packed).read_all()


def _codes(rows: pa.RecordBatch | pa.Table, keys: Sequence[str]) -> np.ndarray:
    """A number per row that is equal where all keys are (NULL equals NULL)."""
    code = np.zeros(rows.num_rows, np.int64)
    for c in keys:
        column = rows.column(c)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        own = column.dictionary_encode(null_encoding="encode")
        code = np.unique(code * (len(own.dictionary) + 1) + own.indices.to_numpy(), return_inverse=True)[1]
    return code


def _newest_rows(rows: pa.RecordBatch | pa.Table, keys: Sequence[str], by: Sequence[str]) -> np.ndarray:
    """Where the newest row of each key stands."""
    code = _codes(rows, keys)
    order = np.lexsort([*(rows.column(c).to_numpy() for c in reversed(by)), code])
    return order[np.append(code[order][1:] != code[order][:-1], True)] if len(order) else order


def apply_stream(spark: SparkSession, src_dir: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str], out_dir: str,
                 checkpoint: str, fmt: str = "parquet", max_files_per_trigger: int | None = None, buckets: int = BUCKETS):
    """Process what lies in ``src_dir`` (a later call with the same checkpoint goes on) and
    write the changes; returns the finished query."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/run={stream_id(spark, checkpoint)}/epoch={epoch}")

    query = (changes_of(reader.load(src_dir), keys, order, buckets).writeStream.outputMode("append").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_changes(spark: SparkSession, out_dir: str) -> DataFrame:
    """All changes with the epoch that made them."""
    return _epochs(spark, out_dir)


def live_table(spark: SparkSession, out_dir: str, keys: Sequence[str]) -> DataFrame:
    """The live rows: the newest change of each key, unless it is a delete."""
    newest = latest_by_key(read_changes(spark, out_dir), keys, ["epoch"], tombstones="resurface", flag="")
    return newest.filter(F.col(CHANGE) != "delete").drop(CHANGE, "run", "epoch")
