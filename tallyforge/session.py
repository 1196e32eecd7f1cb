"""Spark session defaults and the shared scratch location.

Nothing here hard-codes a cluster: the session is configured for correctness
(UTC, ANSI, AQE) and the scratch root is read from ``spark.checkpoint.dir``.
Only when that setting is absent (local tests) is a fresh temporary folder
created and registered.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on. They are safe at any scale:
# AQE re-plans joins from runtime sizes (broadcast only below the threshold,
# sort-merge beyond it), coalesces small shuffle partitions and splits skewed
# ones.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target size of post-shuffle partitions; AQE coalesces towards it
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Broadcast only sides whose runtime size is under 32 MB; larger sides
    # fall back to a shuffled sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "tallyforge",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster call it without ``master``; locally pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, gold tables and streaming state.

    Reads ``spark.checkpoint.dir`` from the session. If it is unset in local
    mode (tests, a laptop) a new temporary folder is created and registered,
    so that ``DataFrame.checkpoint()`` works too. On a cluster the setting must
    point to shared storage (HDFS, object store) and an unset value is an
    error: a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store): "
                               "stored intermediates must survive the loss of an executor")
        root = tempfile.mkdtemp(prefix="tallyforge-")   # local mode only (tests, a laptop)
        spark.conf.set("spark.checkpoint.dir", root)
    else:
        root = root.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd-checkpoints"))
    return root


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for stored intermediates of this application."""
    return f"{scratch_root(spark)}/materialized/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


_DATABASES: dict[str, set[str]] = {}


def drop_databases(spark: SparkSession, *names: str) -> None:
    """Have ``clean_scratch`` drop these databases, which lie below the scratch folder."""
    _DATABASES.setdefault(spark.sparkContext.applicationId, set()).update(names)


def clean_scratch(spark: SparkSession) -> None:
    """Delete the intermediates this application has stored and the databases registered
    with ``drop_databases``. Call it when no DataFrame made so far will be read again, at
    the end of a job."""
    for name in _DATABASES.pop(spark.sparkContext.applicationId, ()):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    remove_path(spark, f"{scratch_root(spark)}/materialized/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Write ``df`` once under the shared scratch root and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing upstream stages) and lets several consumers share one
    computation; unlike an RDD checkpoint the result stays columnar, so later
    scans prune columns and push filters. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.mode("overwrite").format(fmt).options(**options).save(path)
    return spark.read.format(fmt).load(path)


# --------------------------------------------------- files of the shared folder

def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop sees them: any store that Spark can reach."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other fault of the store is raised."""
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written below its own roots."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)
