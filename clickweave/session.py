"""SparkSession construction and the shared scratch location.

The session settings below are the ones the operators rely on:

* ``spark.sql.session.timeZone=UTC`` - offset-less ISO timestamps in the
  input are UTC (the reference's sink reads them that way).
* AQE with partition coalescing and skew-join splitting - hot keys
  (one session, one page, one window) are split at runtime instead of
  landing in one task.
* the Spark UI stays off; nothing here opens a port.

Lineage cuts and streaming checkpoints go under ``spark.checkpoint.dir``
which on a cluster names a shared folder. We only set it when it is
unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
# Writer options of staged tables of whole records: a third less disk than Spark's
# default. Sides of joins keep the default, their size on disk decides on broadcasts.
COMPACT = {"compression": "zstd"}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "clickweave",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session configured for the clickweave operators."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Parquet timestamps without UTC adjustment stay TIMESTAMP_NTZ.
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
        # remove checkpoint files of fan-out frames once they are unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster the operator of the cluster names a shared folder in
    ``spark.checkpoint.dir``; we read it from the session. Only a session
    whose driver and executors are one process (master ``local[...]``) may
    do without: it gets a fresh folder under the system temp directory.
    Any other master raises, since each executor would write to its own disk.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors of {master} share")
        path = tempfile.mkdtemp(prefix="clickweave-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


# Written tables that plans may still read: folder and a weak reference to
# the relation that every plan over the table shares.
_STAGED: list[tuple[str, object]] = []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def sweep(spark: SparkSession) -> None:
    """Delete the staged tables that no plan can read any more.

    A table is gone once the JVM has collected its relation, as Spark's own
    cleaner does with shuffles and checkpoints.
    """
    for entry in [e for e in _STAGED if e[1].get() is None]:
        _STAGED.remove(entry)
        _delete(spark, entry[0])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` if it is columns and rows of a written table, else ``staged``."""
    node = df._jdf.queryExecution().analyzed()
    while node.children().size() == 1 and node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().apply(0)
    return df if node.nodeName().startswith(("LogicalRelation", "Relation")) else staged(df, name)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once, with the given writer options, to the shared folder and return the written table.

    Cuts the lineage (a lost executor rereads files instead of recomputing),
    lets the reader prune columns and gives Catalyst real sizes to plan joins
    with. The folder goes when no plan reads it any more, or at the latest
    when the session's file system is closed.
    """
    spark = df.sparkSession
    sweep(spark)
    path = scratch_dir(spark, name)
    df.write.options(**options).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    table = spark.read.schema(df.schema).parquet(path)
    relation = table._jdf.queryExecution().analyzed().relation()
    _STAGED.append((path, spark._jvm.java.lang.ref.WeakReference(relation)))
    return table
