"""Page views per window, threshold alerts, raw landing.

Every function takes a batch *or* a streaming frame of parsed messages
(``sources.decode.parse_messages``), so the streaming job and its batch
twin share one definition.

Counting is a two-step aggregate: each record contributes the number of
page_view entries in its events array (a per-row expression), and the
window aggregate sums those with a map-side partial sum. The reference
keys every element by one constant and groups them, which puts a whole
window on one worker; here a hot window is combined inside each task
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.scalars import iso_text, minute_label, shard_label, utf8_text
from clickweave.schemas import ATTRIBUTES, MESSAGE
from clickweave.sources.decode import MISSING_SESSION_ID, parse_messages

# Fixed values from the reference's streaming job.
DEFAULT_WINDOW_MINUTES = 1
DEFAULT_DOS_THRESHOLD = 10
DEFAULT_NUM_SHARDS = 5
PAGE_VIEW = "page_view"

# A message with this attribute carries no session. Its publish time moves the
# watermark, so that the windows before it close at the end of the input.
CONTROL, FLUSH = "control", "flush"


def flush_message(messages: DataFrame, window_minutes: int = DEFAULT_WINDOW_MINUTES) -> DataFrame:
    """One message, a window later than the last of ``messages``, that closes every window."""
    after = F.max("publish_time") + F.make_dt_interval(mins=F.lit(window_minutes))
    row = messages.agg(after.alias("publish_time")).where("publish_time is not null")
    return row.select(
        F.lit(FLUSH).alias("message_id"), "publish_time",
        F.array(F.struct(F.lit(CONTROL).alias("key"), F.lit(FLUSH).alias("value"))).alias("attributes"), F.lit(None).cast("binary").alias("data"),
    ).select(*MESSAGE.names)


def page_views_per_record(parsed: DataFrame, time_col: str = "publish_time") -> DataFrame:
    """number of page_view entries per decodable record.

    As in the reference, neither a session id nor an event timestamp is
    required (records rejected only for a missing session id still count).
    Unlike the reference, a NULL entry does not stop the count for the
    rest of the record (SURVEY §4.4). A flush message has none, but its time
    counts for the watermark.
    """
    ok = F.col("reject_reason").isNull() | (F.col("reject_reason") == MISSING_SESSION_ID)
    if "attributes" in parsed.columns:
        ok |= F.coalesce(F.exists("attributes", lambda a: (a["key"] == CONTROL) & (a["value"] == FLUSH)), F.lit(False))
    evs = F.coalesce(F.col("rec.events"), F.array())
    n = F.size(F.filter(evs, lambda e: e["event"]["event_type"] == F.lit(PAGE_VIEW)))
    return parsed.where(ok).select(F.col(time_col).alias("event_time"), n.cast("long").alias("page_views"))


def page_view_counts(
    parsed: DataFrame,
    window_minutes: int = DEFAULT_WINDOW_MINUTES,
    time_col: str = "publish_time",
    watermark: str | None = None,
) -> DataFrame:
    """``(window_end, page_view_count)`` per tumbling window.

    Windows are epoch-aligned on the message *publish* time; the end is
    exclusive. Windows without page views give no row. On a streaming
    frame pass ``watermark`` (e.g. ``"0 seconds"``: fire once when the
    watermark passes the window end, drop later rows).
    """
    per = page_views_per_record(parsed, time_col)
    if watermark is not None:
        per = per.withWatermark("event_time", watermark)
    counts = per.groupBy(F.window("event_time", f"{window_minutes} minutes").alias("w")).agg(
        F.sum("page_views").alias("page_view_count")
    )
    return counts.where(F.col("page_view_count") > 0).select(
        F.col("w.end").alias("window_end"), F.col("page_view_count").cast("long").alias("page_view_count")
    )


def with_alert_flag(counts: DataFrame, threshold: int = DEFAULT_DOS_THRESHOLD) -> DataFrame:
    """T4: mark windows whose count is strictly above the threshold.

    The count row itself passes through unchanged, as in the reference.
    """
    return counts.withColumn("threshold", F.lit(threshold).cast("long")).withColumn(
        "is_alert", F.col("page_view_count") > F.lit(threshold)
    )


def page_view_alerts(counts: DataFrame, threshold: int = DEFAULT_DOS_THRESHOLD) -> DataFrame:
    """Only the windows above the threshold (the alert table)."""
    return with_alert_flag(counts, threshold).where(F.col("is_alert")).drop("is_alert")


LATE = "late"


def late_rejects(messages: DataFrame) -> DataFrame:
    """Messages that came after their window was closed, as rejects; the payload is the page views they had."""
    parsed = parse_messages(messages)
    views = F.size(F.filter(F.coalesce(F.col("rec.events"), F.array()), lambda e: e["event"]["event_type"] == F.lit(PAGE_VIEW)))
    counted = F.col("reject_reason").isNull() | (F.col("reject_reason") == MISSING_SESSION_ID)
    payload = F.struct(iso_text(F.col("publish_time")).alias("publish_time"), F.when(counted, views).otherwise(0).alias("page_views"))
    none = F.lit(None).cast("int")
    return parsed.select(
        "source", F.lit("record").alias("stage"), F.lit(LATE).alias("reason"), F.col("rec.session_id").alias("session_id"),
        none.alias("event_pos"), none.alias("item_pos"), F.to_json(payload).alias("payload"),
    )


def raw_landing_rows(messages: DataFrame, num_shards: int = DEFAULT_NUM_SHARDS) -> DataFrame:
    """Every message keyed by publish hour, minute and stable shard.

    Columns ``hour, minute, shard, message_id, publish_time, attributes,
    value, data64``: the text, or, if the bytes are no UTF-8 text, the bytes
    in base64. The hour of a message without a publish time is ``none``.
    """
    if "value" in messages.columns:
        text, other = F.col("value"), F.lit(None).cast("string")
    else:
        text = utf8_text(F.col("data"))
        other = F.when(text.isNull(), F.base64("data"))
    return messages.select(
        F.coalesce(F.date_format("publish_time", "yyyy-MM-dd-HH"), F.lit("none")).alias("hour"),
        minute_label(F.col("publish_time")).alias("minute"),
        shard_label(F.col("message_id"), num_shards).alias("shard"),
        "message_id", "publish_time",
        (F.col("attributes") if "attributes" in messages.columns else F.lit(None).cast(ATTRIBUTES)).alias("attributes"),
        text.alias("value"),
        other.alias("data64"),
    )


RAW_LINE = "message_id string, publish_time string, attributes array<struct<key:string,value:string>>, minute string, shard string, value string, data64 string"


def raw_lines(rows: DataFrame) -> DataFrame:
    """``hour, value``, each message as one line of JSON: line feeds inside it are escaped."""
    # JSON writes times to the millisecond
    at = F.concat(iso_text(F.col("publish_time")), F.lit("Z")).alias("publish_time")
    return rows.select("hour", "message_id", F.to_json(F.struct("message_id", at, "attributes", "minute", "shard", "value", "data64")).alias("value"))


def read_raw_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed messages again: ``message_id, publish_time, attributes, data, minute, shard``."""
    lines = spark.read.schema("value string, hour string, batch_id long").text(path)
    m = lines.select(F.from_json("value", RAW_LINE).alias("m")).select("m.*")
    return m.select(
        "message_id", F.col("publish_time").cast("timestamp").alias("publish_time"), "attributes",
        F.coalesce(F.encode("value", "UTF-8"), F.unbase64("data64")).alias("data"), "minute", "shard",
    )
