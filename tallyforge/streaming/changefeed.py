"""Continuous change-feed apply with Structured Streaming.

Change rows (one landing folder per source, fixed schema) are read as a
stream; every micro-batch is reduced to its newest row per key and written to
``<state>/run=<stream id>/epoch=<n>``. The current state is "newest row per
key" over all of these folders: an associative, commutative, idempotent fold,
so

* replaying micro-batches in any order, or twice, equals one batch over their
  union; an older version arriving late never overwrites a newer one (no
  watermark needed: state is bounded by the number of keys, not by time);
* a retried epoch overwrites its own folder;
* a stream that starts over with a new checkpoint has a new id and counts its
  epochs in a folder of its own: nothing written before can be overwritten.

Per micro-batch the cost is O(batch), not O(state). ``compact`` folds finished
epochs into one. Where the table format supports MERGE (Delta, Iceberg), a
MERGE INTO per batch is the alternative sink.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import apply_changes, live_view
from ..session import path_exists, remove_path

COMPACTED = "compacted-"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives its stream; it survives restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def stream_apply(spark: SparkSession, src_dir: str, schema: T.StructType, keys: Sequence[str] | str,
                 order: Sequence[str] | str, state_dir: str, checkpoint: str,
                 tiebreak: Sequence[str] | str | None = None, fmt: str = "parquet",
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int | None = None):
    """Start the apply stream; with ``available_now`` it processes what is there
    and stops (returns after termination), else it runs on ``processing_time``."""
    def fold(batch: DataFrame, epoch_id: int) -> None:
        apply_changes(None, batch, keys, order, tiebreak).write.mode("overwrite").parquet(
            f"{state_dir}/run={stream_id(spark, checkpoint)}/epoch={epoch_id}")

    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    reader = reader.load(src_dir)
    writer = reader.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def _epochs(spark: SparkSession, state_dir: str) -> DataFrame:
    if not path_exists(spark, state_dir):
        raise FileNotFoundError(f"no state under {state_dir}")
    return spark.read.option("basePath", state_dir).parquet(f"{state_dir}/run=*")


def read_state(spark: SparkSession, state_dir: str, keys, order, tiebreak=None) -> DataFrame:
    """Applied state, tombstones kept: newest row per key over all epochs."""
    return apply_changes(None, _epochs(spark, state_dir).drop("run", "epoch"), keys, order, tiebreak)


def read_live(spark: SparkSession, state_dir: str, keys, order, tiebreak=None) -> DataFrame:
    return live_view(read_state(spark, state_dir, keys, order, tiebreak))


def compact(spark: SparkSession, state_dir: str, keys, order, tiebreak=None) -> int:
    """Fold finished epochs into one folder; returns how many were folded.

    The last epoch of a stream stays, as it may still be written. The folded
    epochs are removed only after the new folder is complete, and an epoch read
    twice changes nothing, so a failure at any point loses no row. Readers that
    listed the old folders before must read again.
    """
    rows = _epochs(spark, state_dir)
    found = rows.select("run", "epoch").distinct().collect()          # one row per folder
    last = {}
    for r in found:
        last[r["run"]] = max(r["epoch"], last.get(r["run"], -1))
    done = [(r["run"], r["epoch"]) for r in found if r["run"].startswith(COMPACTED) or r["epoch"] < last[r["run"]]]
    if len(done) < 2:
        return 0
    own = spark.createDataFrame(done, "run string, epoch int")
    folded = apply_changes(None, rows.join(F.broadcast(own), ["run", "epoch"], "left_semi").drop("run", "epoch"), keys, order, tiebreak)
    folded.write.parquet(f"{state_dir}/run={COMPACTED}{uuid.uuid4().hex}/epoch=0")
    for run, epoch in done:
        remove_path(spark, f"{state_dir}/run={run}" + ("" if run.startswith(COMPACTED) else f"/epoch={epoch}"))
    return len(done)
