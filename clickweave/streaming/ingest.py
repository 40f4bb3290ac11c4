"""Structured Streaming jobs.

Sources
  * ``file_sessions_stream`` - new JSONL files in a folder, each read once
    (checkpointed file list), optionally archived after they are read.
    With ``trigger(availableNow=True)`` this is the scheduled catch-up job
    (every N minutes, or when a file lands).
  * ``kafka_messages_stream`` - the production message bus, normalised
    to ``message_id, publish_time, attributes, data``.
  * ``message_files_stream`` - the same normalised frame from Parquet
    files (tests, replays).

Sinks (each query has its own checkpoint, so a restarted or re-run query
resumes where it stopped and every query sees the whole topic):
  * ``start_live_ingest``   - visits/events/purchase_items/rejects per micro
    batch via ``foreachBatch``, to the tables the batch job writes. A micro
    batch is a load of its own, committed as a whole, so a replayed one
    replaces its own rows instead of appending twice.
  * ``start_page_views``    - windowed counts (append mode: a window is
    written once, when the watermark passes its end), the alert rows, and
    late messages as rejects, likewise.
  * ``start_raw_landing``   - raw messages as lines, by hour and batch.
  * ``start_decoded``       - decoded records as files, which other streams read.
  * ``start_updates``       - changed groups of a running aggregate.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickweave.functions.scalars import money_exact, money_of, money_rest
from clickweave.operators import extract
from clickweave.schemas import DECODED, MESSAGE, PAGE_VIEWS
from clickweave.session import COMPACT, staged
from clickweave.sinks import tables as sinks
from clickweave.sources.decode import parse_messages, parse_sessions
from clickweave.streaming import pageviews


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def file_sessions_stream(
    spark: SparkSession,
    input_dir: str,
    glob: str = "*.jsonl",
    archive_dir: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """New session files as lines with their source path.

    ``archive_dir`` moves each file there (under its full source path) once
    its batch is committed (``cleanSource=archive``), so exactly the files
    that were read are archived. Spark commits a batch's source offsets
    when it plans the next batch, so the files of the newest batch stay in
    place until more data arrives; the checkpointed file list still
    guarantees they are not read twice.
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", glob)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(input_dir)
    return df.select("value", F.col("_metadata.file_path").alias("source"))


def kafka_messages_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                          starting_offsets: str = "earliest") -> DataFrame:
    """S3: Kafka records as normalised messages (needs the Kafka connector on the classpath).

    ``message_id`` is ``topic/partition/offset`` (unique, stable on replay);
    ``publish_time`` is the record timestamp; headers become attributes.
    """
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("includeHeaders", "true")
        .load()
    )
    # a header may be there several times: pairs, not a map
    attrs = F.transform(F.col("headers"), lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")))
    return raw.select(
        F.concat_ws("/", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")).alias(
            "message_id"
        ),
        F.col("timestamp").alias("publish_time"),
        attrs.alias("attributes"),
        F.col("value").alias("data"),
    )


def message_files_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Normalised messages from Parquet files (same columns as Kafka's)."""
    reader = spark.readStream.schema(MESSAGE).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(input_dir)


# ----------------------------------------------------------------- live ingest

def write_batch_partition(df: DataFrame, path: str, batch_id: int, partitions: tuple[str, ...] = (), kind: str = "parquet", **options: str) -> None:
    """Write one micro batch under ``batch_id=<id>``, replacing a previous attempt.

    Dynamic partition overwrite touches only that partition, so replaying a
    batch after a failure is idempotent and other batches are untouched.
    """
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .options(partitionOverwriteMode="dynamic", **options)
        .partitionBy("batch_id", *partitions)
        .format(kind)
        .save(path)
    )


def write_batch_tables(parsed: DataFrame, database: str, batch_id: int, profile: str = extract.LIVE, stream: str = "live", after_table=None, skip_known: bool = False) -> dict[str, int]:
    """K4: one micro batch -> the curated tables, as one load ``<stream>-<batch_id>``.

    The parsed batch is persisted so the writes share one decode. The load is
    committed last, so readers see all of the batch or nothing, and a replay
    (after a failure between writes) replaces its rows in all tables at once.
    Visits go in as parts, which merge with the parts of other batches when
    they are read. ``skip_known`` leaves out rows whose key another committed
    load has (R5). The load's metrics become a row of ``job_runs``.
    """
    spark, load_id = parsed.sparkSession, f"{stream}-{batch_id}"
    parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tables = extract.tables(parsed, profile)
        if skip_known:
            tables = sinks.without_known(spark, tables, database, load_id)
        metrics = sinks.write_load(spark, tables, database, load_id, after_table=after_table)
    finally:
        parsed.unpersist()
    if not skip_known:  # else known visits are not among those written
        metrics["input_records"] = metrics["visits_rows"] + metrics["record_rejects"]
    sinks.record_job_run(spark, database, job_name=stream, status="SUCCEEDED", source=None, destination=database, metrics=metrics, run_id=load_id)
    return metrics


def start_live_ingest(
    parsed_stream: DataFrame,
    database: str,
    checkpoint: str,
    profile: str = extract.LIVE,
    trigger: dict | None = None,
    stream: str = "live",
    skip_known: bool = False,
) -> StreamingQuery:
    """Run ``write_batch_tables`` for every micro batch.

    ``stream`` names the query in the load ids of its rows.
    """
    sinks.provision(parsed_stream.sparkSession, database)
    writer = parsed_stream.writeStream.foreachBatch(
        lambda df, batch_id: write_batch_tables(df, database, batch_id, profile, stream, skip_known=skip_known)
    ).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


# ------------------------------------------------------------------ page views

def _watermark(spark: SparkSession, database: str, stream: str, before: int, delay: str):
    """The event-time watermark that micro batch ``before`` judges late rows by, NULL if there is none.

    Spark drops a row by the watermark of the batch before: the latest time
    in the batches before that one, less the delay. Loads carry the latest
    time of their batch, so a replayed batch is judged as the first time.
    """
    number = F.regexp_extract("load_id", rf"^{stream}-(\d+)$", 1)
    loads = spark.table(f"`{database}`.`loads`").where(F.col("load_id").rlike(rf"^{stream}-\d+$") & (number.cast("long") < before - 1))
    latest = F.timestamp_micros(F.max(F.col("metrics")["latest_micros"]))
    return loads.agg((latest - F.expr(f"INTERVAL {delay}")).alias("watermark")).first()[0]  # one row


def start_page_views(
    messages_stream: DataFrame,
    database: str,
    checkpoint: str,
    window_minutes: int = pageviews.DEFAULT_WINDOW_MINUTES,
    threshold: int = pageviews.DEFAULT_DOS_THRESHOLD,
    watermark: str = "0 seconds",
    trigger: dict | None = None,
    stream: str = "page_views",
) -> StreamingQuery:
    """Closed windows, their alerts and late messages, into the tables.

    Append mode emits a window once, when the watermark (latest publish time
    seen minus ``watermark``) passes its end, and drops what is later. The
    messages themselves pass beside the counts, not decoded, through the same
    query, so the batch that drops a message can tell: one whose window
    the watermark had passed goes to ``rejects`` with the reason ``late`` and
    its page views. All three tables of a batch are one load.
    """
    spark = messages_stream.sparkSession
    sinks.provision(spark, database)
    timed = messages_stream.withWatermark("publish_time", watermark)
    counts = pageviews.page_view_counts(parse_messages(timed), window_minutes)
    none = {f.name: F.lit(None).cast(f.dataType) for f in PAGE_VIEWS.fields}
    sides = {c: F.lit(None).cast(timed.schema[c].dataType) for c in timed.columns}
    both = counts.select(*counts.columns, *(v.alias(c) for c, v in sides.items()), F.lit(True).alias("is_count")).unionByName(
        timed.select(*(v.alias(c) for c, v in none.items()), *timed.columns, F.lit(False).alias("is_count"))
    )

    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            closed = df.where("is_count").select(*counts.columns)
            messages = df.where("not is_count").select(*timed.columns)
            passed = _watermark(spark, database, stream, batch_id, watermark)
            ends = F.window("publish_time", f"{window_minutes} minutes")["end"]
            late = messages.where(ends <= F.lit(passed)) if passed is not None else messages.limit(0)
            load_id = f"{stream}-{batch_id}"
            attempt, metrics = sinks.new_attempt(load_id), {}
            for name, rows in (("page_views", closed), ("page_view_alerts", pageviews.page_view_alerts(closed, threshold)), ("rejects", pageviews.late_rejects(late))):
                metrics |= sinks.write_attempt(rows, name, database, attempt)
            latest = messages.agg(F.max(F.unix_micros("publish_time"))).first()[0]  # of the persisted batch
            if latest is not None:
                metrics["latest_micros"] = latest
            sinks.commit(spark, database, load_id, attempt, metrics=metrics)
        finally:
            df.unpersist()

    writer = both.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def start_raw_landing(
    messages_stream: DataFrame,
    output_dir: str,
    checkpoint: str,
    num_shards: int = pageviews.DEFAULT_NUM_SHARDS,
    rows_per_file: int = 100_000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """K5: raw messages as lines of text files under ``batch_id=.../hour=...``.

    Each line names the minute and the shard of its message. An hour of a
    micro batch is spread over as many tasks and files as its rows need, so
    neither a hot minute nor a quiet hour with a file per minute hurts. Files
    are compressed by gzip, which is read as a whole: ``rows_per_file`` bounds them.
    """

    def sink(df: DataFrame, batch_id: int) -> None:
        rows = pageviews.raw_lines(pageviews.raw_landing_rows(df, num_shards)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            files = rows.groupBy("hour").agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("files"))
            spread = rows.join(files, "hour").withColumn("file", F.pmod(F.xxhash64("message_id"), F.col("files")))
            spread = spread.repartition("hour", "file").select("value", "hour")
            write_batch_partition(spread, output_dir, batch_id, ("hour",), "text", compression="gzip")
        finally:
            rows.unpersist()

    writer = messages_stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def parse_file_stream(lines: DataFrame) -> DataFrame:
    """Parsed session records from a file stream (S7 -> S2)."""
    return parse_sessions(lines)


def parse_message_stream(messages: DataFrame) -> DataFrame:
    """Parsed session records from a message stream (S3 -> S6)."""
    return parse_messages(messages)


def start_decoded(parsed_stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The records of a decoded stream as files (``schemas.DECODED``), for the streams that read them with ``decoded_stream``.

    Filtering replays and decoding are done once, not once per reader, and
    readers take the members they need. Spark's file sink logs the files of
    a finished batch, so one that is run again after a failure is read once.
    """
    writer = parsed_stream.select(*DECODED.names).writeStream.format("parquet").outputMode("append").options(**COMPACT)
    return _trigger(writer.option("checkpointLocation", checkpoint), trigger).start(path)


def decoded_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The decoded records that ``start_decoded`` wrote, as a stream."""
    reader = spark.readStream.schema(DECODED).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


# ------------------------------------------------------------ live dashboard

DASHBOARD_LATENESS = "1 day"


def without_replays(messages_stream: DataFrame, within: str = "1 hour") -> DataFrame:
    """R5 on a stream: a message that is delivered again within the time is dropped; older ids leave the state."""
    return messages_stream.withWatermark("publish_time", within).dropDuplicatesWithinWatermark(["message_id"])


def live_dashboard_aggregates(parsed_stream: DataFrame, profile: str = extract.LIVE, lateness: str = DASHBOARD_LATENESS) -> dict[str, DataFrame]:
    """The dashboard reports by publish day, as streaming aggregates of bounded state.

    Every aggregate is keyed by the day's window, so the watermark evicts a day
    ``lateness`` after its end; what was written of it stays and adds up
    with other days in ``read_dashboard``. ``visits_by_device`` (A7) counts a
    session by its whole record or its first part, so the further parts of a
    long session, in whatever batch, count nothing. ``product_totals`` (A5
    before the top-k cut) and ``sales_by_category`` (A6) carry sums that
    add up exactly. ``visits_by_page`` (A4) is the day's distinct (page,
    session) pairs, evicted likewise, and a sketch per page and day, which
    merges over days that share sessions.
    """
    timed = parsed_stream if _has_watermark(parsed_stream) else parsed_stream.withWatermark("publish_time", lateness)
    day = F.window("publish_time", "1 day").alias("day")
    visits = extract.visit_parts(timed, keep=["publish_time"]).where("coalesce(part, 0) = 0")
    items = extract.purchase_items(timed, profile, keep=["publish_time"])
    views = extract.events(timed, profile, keep=["publish_time"]).where("event_type = 'page_view'").select(day, "page_url", "session_id")
    price, quantity = F.col("price"), F.col("quantity")
    return {
        "visits_by_device": visits.groupBy(day, "device_type").agg(F.count(F.lit(1)).alias("visits")),
        "product_totals": items.groupBy(day, "product_id").agg(F.sum(F.coalesce(quantity, F.lit(0)).cast("decimal(38,0)")).alias("quantity"), F.count(F.lit(1)).alias("order_lines")),
        "sales_by_category": items.groupBy(day, "category").agg(F.try_sum(money_exact(price, quantity)).alias("exact"), F.sum(money_rest(price, quantity)).alias("rest"), F.count(F.lit(1)).alias("item_rows")),
        "visits_by_page": views.dropDuplicates(["day", "page_url", "session_id"]).groupBy("day", "page_url").agg(F.count(F.lit(1)).alias("visits"), F.hll_sketch_agg("session_id").alias("sketch")),
    }


#: Per report: its key, and how its columns add up over days.
DASHBOARD = {
    "visits_by_device": ("device_type", {"visits": F.sum}),
    "product_totals": ("product_id", {"quantity": F.sum, "order_lines": F.sum}),
    "sales_by_category": ("category", {"exact": F.try_sum, "rest": F.sum, "item_rows": F.sum}),
    "visits_by_page": ("page_url", {"visits": F.sum, "sketch": F.hll_union_agg}),
}


def _has_watermark(df: DataFrame) -> bool:
    return "EventTimeWatermark" in df._jdf.queryExecution().analyzed().toString()


def start_updates(aggregate: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the groups that a micro batch changed, as they are now, under its ``batch_id``.

    Readers see finished batches only, and a trigger writes no more groups
    than it changed.
    """
    writer = aggregate.writeStream.outputMode("update").foreachBatch(lambda df, batch_id: write_batch_partition(_day_start(df), path, batch_id))
    return _trigger(writer.option("checkpointLocation", checkpoint), trigger).start()


def _day_start(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col("day.start").cast("date")) if "day" in df.columns else df


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The latest state of every group that ``start_updates`` wrote."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_now"))
    return latest.select(*keys, "_now.*")


def compact_updates(spark: SparkSession, path: str, keys: list[str], keep_batches: int = 1) -> int:
    """Gather all but the newest batches of an update log, leaving the latest state of each group.

    The gathered state takes the place of the newest batch gathered, by a
    dynamic overwrite of that one partition; the older ones go afterwards.
    A reader between, and a failure between, see states that are there twice
    or superseded, which ``read_updates`` reads as the same. Returns the
    number of batches gathered.
    """
    rows = spark.read.parquet(path)
    batches = sorted(r[0] for r in rows.select("batch_id").distinct().collect())  # a row a batch
    old = batches[: len(batches) - keep_batches]
    if len(old) < 2:
        return 0
    gone = staged(rows.where(F.col("batch_id") <= old[-1]), "updates")
    rest = [c for c in rows.columns if c not in (*keys, "batch_id")]
    latest = gone.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_now")).select(*keys, "_now.*")
    write_batch_partition(latest, path, old[-1])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for batch in old[:-1]:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch}")
        folder.getFileSystem(conf).delete(folder, True)
    return len(old)


def read_dashboard(spark: SparkSession, path: str, report: str) -> DataFrame:
    """A report over all days, from the update log of its aggregate."""
    key, sums = DASHBOARD[report]
    total = read_updates(spark, path, ["day", key]).groupBy(key).agg(*(f(c).alias(c) for c, f in sums.items()))
    if report == "product_totals":
        return total.select(key, F.col("quantity").try_cast("bigint").alias("total_quantity"), "order_lines")
    if report == "sales_by_category":
        return total.select(key, money_of(F.col("exact"), F.col("rest")).alias("sales"), "item_rows")
    if report == "visits_by_page":
        return total.select(key, "visits", F.hll_sketch_estimate("sketch").alias("sessions_estimate"))
    return total
