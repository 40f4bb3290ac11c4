"""Batch job: JSONL session files -> curated tables.

    read text -> parse once -> {visits, events, purchase_items, rejects} -> append -> job_runs

The four outputs share one read and one parse (P6). By default the parsed
records are checkpointed (``DataFrame.checkpoint``) into the shared folder
named by ``spark.checkpoint.dir``: lineage is cut, so losing an executor
during the four writes costs only re-reading checkpoint files, never
re-parsing the input. ``fanout="persist"`` keeps them in executor
memory/disk instead (cheaper for small inputs; lost blocks are recomputed
from the input files). Each output is a narrow transform of the parsed
frame, so the job has no shuffle. Row counts come from ``observe`` on the
frames as they are written (A10); nothing is read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators import extract
from clickweave.session import ensure_checkpoint_dir, staged
from clickweave.sinks import tables as sinks
from clickweave.sources.decode import parse_sessions, read_jsonl


def run_batch(
    spark: SparkSession,
    input_path: str,
    database: str = sinks.CURATED_DB,
    mode: str = "append",
    profile: str = extract.BATCH,
    glob: str | None = "*.jsonl",
    job_name: str = "batch_sessions",
    min_partitions: int | None = None,
    land_raw_lines: bool = False,
    fanout: str = "checkpoint",
    run_id: str | None = None,
    archive_dir: str | None = None,
    skip_known: bool = False,
    after_table: Callable[[str], None] | None = None,
    after_file: Callable[[str], None] | None = None,
) -> dict[str, int]:
    """Load every matching file under ``input_path`` into the curated tables.

    Returns the metrics written to ``job_runs``: rows per output table and
    the number of input records. ``land_raw_lines`` also appends the lines
    to the raw zone (``raw.sessions_raw``) before parsing. ``min_partitions`` repartitions after the
    read, for inputs of a few large non-splittable (gzip) files. ``mode``
    is that of ``sinks.tables.write_load``: the four tables are one load,
    committed last. ``after_table`` is called after each table is written.
    ``skip_known`` leaves out rows whose key another committed load has (R5).
    ``archive_dir`` moves the files that were read there (K6). The files a
    load has read are rows of its table ``files``, so with an archive no file
    is loaded twice: a run that was stopped before its commit loads them, one
    that was stopped after it, or any later run, archives what is left.
    ``after_file`` is called after each move.
    """
    run_id = run_id or uuid.uuid4().hex
    load_id = f"{job_name}-{run_id}"
    sinks.provision(spark, database)
    target = f"{archive_dir.rstrip('/')}/{load_id}" if archive_dir else None
    if target:
        done = spark.table(f"`{database}`.`loads`").where(F.col("load_id") == load_id).orderBy(F.col("version").desc()).first()
        if done:  # its files may be archived already: only what is left of that is done
            archive(spark, known_files(spark, input_path, glob, database), target, after_file)
            return _run_metrics(done["metrics"])
    lines = read_jsonl(spark, input_path, glob=glob)
    if target:
        known = staged(known_files(spark, input_path, glob, database).select(F.col("path").alias("source")), "known-files")
        if not known.isEmpty():  # a run was stopped while it archived
            lines = lines.join(known, "source", "left_anti")
    if min_partitions:
        lines = lines.repartition(min_partitions)
    if land_raw_lines:
        sinks.land_raw(lines, load_id=load_id)
    parsed = parse_sessions(lines)
    if fanout == "checkpoint":
        ensure_checkpoint_dir(spark)
        parsed = parsed.checkpoint(eager=True)
    elif fanout == "persist":
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    else:
        raise ValueError(f"fanout must be checkpoint or persist, got {fanout!r}")
    try:
        tables, counted = extract.tables(parsed, profile), {}
        if skip_known:  # visits that are known are no longer counted as they are written
            first = F.coalesce(tables["visits"]["part"], F.lit(0)) == 0
            counted["all_visits"] = tables["visits"].where(first).count()
            tables = sinks.without_known(spark, tables, database, load_id)
        if target:  # the ledger is part of the load: a file is loaded when its rows are
            read = parsed.select(F.col("source").alias("path")).distinct()
            tables["files"] = listed_files(spark, input_path, glob).join(read, "path", "left_semi")
        metrics = _run_metrics(sinks.write_load(spark, tables, database, load_id, mode, after_table, counted))
        sinks.record_job_run(
            spark, database, job_name=job_name, status="SUCCEEDED", source=input_path,
            destination=database, metrics=metrics, run_id=run_id,
        )
        if target:
            archive(spark, known_files(spark, input_path, glob, database), target, after_file)
    finally:
        parsed.unpersist()
    return metrics


def _run_metrics(counted: dict[str, int]) -> dict[str, int]:
    """What a run reports; every input record is either a visit or a record-level reject."""
    rows = {k: v for k, v in counted.items() if k != "files_rows"}
    visits = rows.pop("all_visits", rows["visits_rows"])
    known = {"known_visits": visits - rows["visits_rows"]} if "all_visits" in counted else {}
    return rows | known | {"input_records": visits + rows["record_rejects"]}


def listed_files(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """``path, length, modified`` of the matching files (no content is read)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("_metadata.file_path").alias("path"), "length", F.col("modificationTime").alias("modified"))


def known_files(spark: SparkSession, path: str, glob: str | None, database: str) -> DataFrame:
    """Files that are there and that a committed load has read, as they are now."""
    ledger = spark.table(f"`{database}`.`files`").select("path", "length", "modified").distinct()
    return listed_files(spark, path, glob).join(ledger, ["path", "length", "modified"], "left_semi")


def archive(spark: SparkSession, files: DataFrame, folder: str, after_file: Callable[[str], None] | None = None, at_once: int = 16) -> int:
    """K6: move files below ``folder``, each under its own path, several at once.

    Paths come to the driver partition by partition. A file that is gone has
    been moved by another run. Returns the number of files moved.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def move(name: str) -> bool:
        source = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        target = jvm.org.apache.hadoop.fs.Path(f"{folder}{source.toUri().getPath()}")
        fs = source.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        if fs.rename(source, target):
            return True
        if fs.exists(source):
            raise OSError(f"{name} could not be moved to {target}")
        return False

    moved = 0
    with ThreadPoolExecutor(at_once) as pool:
        paths = (r[0] for r in files.select("path").toLocalIterator())
        while batch := list(islice(paths, 4 * at_once)):
            for name, was_moved in zip(batch, pool.map(move, batch), strict=True):
                moved += was_moved
                if after_file:
                    after_file(name)
    return moved
