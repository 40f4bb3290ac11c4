"""Registered queries: base tables -> session JSON -> decode -> operator.

Session records are built with Spark from the driver's parquet tables and
landed (``sources.derived``). Queries of the extraction, of messages and of
streams decode them like any file or message input and apply one operator
records were landed in (``plans.landing``), with their columns pruned. The
DuckDB oracles in ``plans.oracle`` compute the same answers directly from
the base tables, so the two paths are independent.

TIMESTAMP results are returned as TIMESTAMP_NTZ (UTC wall clock) to
compare with DuckDB's zone-less TIMESTAMP.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.operators import extract, orders, quality, reports
from clickweave.plans.batch import run_batch
from clickweave.plans.curate import decoder_versions, derive, with_decoder_version
from clickweave.plans.landing import landed, parsed_messages, parsed_sessions
from clickweave.sinks import by_session, tables as sinks
from clickweave.sources.decode import decode_push_envelopes, parse_messages, parse_sessions, read_jsonl
from clickweave.functions.scalars import parse_iso_timestamp, shard_label
from clickweave.session import scratch_dir, staged
from clickweave.sources import dirty
from clickweave.streaming import ingest, pageviews
from clickweave.sources.derived import session_messages, session_records


def present(df: DataFrame) -> DataFrame:
    """Cast TIMESTAMP columns to TIMESTAMP_NTZ for comparison with DuckDB."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- extraction

def q_visits(spark, sf_dir):
    return present(extract.visits(parsed_sessions(spark, sf_dir)))


def q_events_batch(spark, sf_dir):
    return present(extract.events(parsed_sessions(spark, sf_dir), extract.BATCH))


def q_events_live(spark, sf_dir):
    return present(extract.events(parsed_messages(spark, sf_dir), extract.LIVE))


def q_purchase_items_batch(spark, sf_dir):
    return present(extract.purchase_items(parsed_sessions(spark, sf_dir), extract.BATCH))


def q_purchase_items_live(spark, sf_dir):
    return present(extract.purchase_items(parsed_messages(spark, sf_dir), extract.LIVE))


def q_rejects_live(spark, sf_dir):
    r = extract.rejects(parsed_messages(spark, sf_dir), extract.LIVE, with_payload=False)
    return r.select("stage", "reason", "session_id", "event_pos", "item_pos")


def q_rejects_batch(spark, sf_dir):
    r = extract.rejects(parsed_sessions(spark, sf_dir), extract.BATCH, with_payload=False)
    return r.select("stage", "reason", "session_id", "event_pos", "item_pos")


# ------------------------------------------------------------------ reports

def _batch_tables(spark, sf_dir):
    return tuple(landed(spark, sf_dir, name) for name in ("visits", "events", "purchase_items"))


def q_visits_by_page(spark, sf_dir):
    return reports.visits_by_page(landed(spark, sf_dir, "events"))


def q_visits_by_device(spark, sf_dir):
    return reports.visits_by_device(landed(spark, sf_dir, "visits"))


def q_popular_items(spark, sf_dir):
    return reports.popular_items(landed(spark, sf_dir, "purchase_items"), k=10)


def q_sales_by_category(spark, sf_dir):
    return reports.sales_by_category(landed(spark, sf_dir, "purchase_items"))


def q_events_with_visit(spark, sf_dir):
    v, e, _ = _batch_tables(spark, sf_dir)
    return present(reports.events_with_visit(e, v))


def q_items_with_visit(spark, sf_dir):
    v, _, i = _batch_tables(spark, sf_dir)
    return present(reports.items_with_visit(i, v))


def q_orphan_counts(spark, sf_dir):
    v, e, i = _batch_tables(spark, sf_dir)
    return quality.orphan_counts({"events": e, "purchase_items": i}, v)


def q_sessions_with_purchase(spark, sf_dir):
    v, _, i = _batch_tables(spark, sf_dir)
    return present(reports.sessions_with_purchase(v, i))


# ---------------------------------------------------------------- quality

def q_key_report(spark, sf_dir):
    v, e, i = _batch_tables(spark, sf_dir)
    return quality.key_report({"visits": v, "events": e, "purchase_items": i})


def _both_visits(spark, sf_dir):
    return landed(spark, sf_dir, "visits"), landed(spark, sf_dir, "live_visits")


def q_dedup_visits(spark, sf_dir):
    """Visits from the file path and the message path, one per session."""
    return present(quality.union_paths(*_both_visits(spark, sf_dir), keys=["session_id"]))


def q_duplicate_visit_keys(spark, sf_dir):
    """A8 on U1 without dedup: both ingest paths append the same sessions,
    as in the reference, and the key check finds every copy."""
    return quality.duplicate_keys(quality.union_paths(*_both_visits(spark, sf_dir)), ["session_id"])


def q_consolidated_visits(spark, sf_dir):
    """R5 for visits: copies from both ingest paths -> one merged row per session."""
    parts = [extract.visit_parts(landed(spark, sf_dir, name)) for name in ("parsed", "live_parsed")]
    return present(quality.consolidate_visits(quality.union_paths(*parts)))


def q_consolidated_parts(spark, sf_dir):
    """The same where sessions are cut into records of 2 events; parts of equal times must all count."""
    rec = session_records(spark, sf_dir, *SMALL_BOUNDS)
    batch = extract.visit_parts(parse_sessions(rec.select("value", F.col("message_id").alias("source"))))
    live = extract.visit_parts(parse_messages(session_messages(spark, sf_dir, *SMALL_BOUNDS)))
    return present(quality.consolidate_visits(quality.union_paths(batch, live)))


def q_union_paths_events(spark, sf_dir):
    """Events written by the batch job and by the live ingest, deduplicated."""
    batch, live = landed(spark, sf_dir, "events"), landed(spark, sf_dir, "live_events")
    return present(quality.union_paths(batch, live, keys=["session_id", "event_unique_id"]))


def q_path_reconciliation(spark, sf_dir):
    """Sessions that have events rows in only one of the two paths."""
    return quality.path_reconciliation(landed(spark, sf_dir, "events"), landed(spark, sf_dir, "live_events"), "session_id")


def q_profile_diff(spark, sf_dir):
    """Events rows the batch profile writes and the live one does not."""
    cols = ["session_id", "event_unique_id", "event_type"]
    return quality.profile_diff(landed(spark, sf_dir, "events"), landed(spark, sf_dir, "live_events"), cols)


# ------------------------------------------------------------------ orders

def q_order_amounts(spark, sf_dir):
    return orders.order_amounts(landed(spark, sf_dir, "purchase_items"))


def q_order_reconciliation(spark, sf_dir):
    _, e, i = _batch_tables(spark, sf_dir)
    return orders.order_reconciliation(e, i)


def q_cart_before_purchase(spark, sf_dir):
    return orders.cart_before_purchase(parsed_sessions(spark, sf_dir))


def q_session_event_order(spark, sf_dir):
    """O2: events re-ordered by timestamp (stable), with their new position."""
    p = orders.sort_session_events(parsed_sessions(spark, sf_dir))
    x = extract.exploded_events(p).where("first_item is null")
    return present(x.select("session_id", "event_pos", "event_type", F.col("ts").alias("timestamp")))


def q_reassembled_visits(spark, sf_dir):
    """Flat batch events -> nested records -> decode -> visits."""
    ev = landed(spark, sf_dir, "events")
    rec = orders.assemble_sessions(ev)
    v = extract.visits(parse_sessions(rec.select("value", F.col("session_id").alias("source"))))
    return present(v.select("session_id", "user_id", "device_type", "start_timestamp", "end_timestamp", "event_count"))


# ------------------------------------------------------------ dirty records

def _dirty_lines(spark, sf_dir):
    rec = dirty.dirty_records(landed(spark, sf_dir, "parsed"))
    return parse_sessions(rec.select("value", F.col("message_id").alias("source"), "publish_time"))


def _dirty_messages(spark, sf_dir):
    return parse_messages(dirty.dirty_messages(landed(spark, sf_dir, "parsed")))


def _reject_rows(parsed, profile):
    return extract.rejects(parsed, profile, with_payload=False).select("stage", "reason", "session_id", "event_pos", "item_pos")


def q_rejects_dirty_batch(spark, sf_dir):
    """Every kind of defect that a line can have."""
    return _reject_rows(_dirty_lines(spark, sf_dir), extract.BATCH)


def q_rejects_dirty_live(spark, sf_dir):
    """The same for messages, with empty and undecodable ones."""
    return _reject_rows(_dirty_messages(spark, sf_dir), extract.LIVE)


def q_visits_dirty(spark, sf_dir):
    """Visits of lines with defects."""
    return present(extract.visits(_dirty_lines(spark, sf_dir)))


def q_events_dirty(spark, sf_dir):
    """Events rows that stay of lines with defects."""
    return present(extract.events(_dirty_lines(spark, sf_dir), extract.BATCH))


def q_items_dirty_batch(spark, sf_dir):
    """Items of lines with defects; a purchase without a time keeps its items."""
    return present(extract.purchase_items(_dirty_lines(spark, sf_dir), extract.BATCH))


def q_items_dirty_live(spark, sf_dir):
    """P5: items of messages with defects; a purchase without a time loses them."""
    return present(extract.purchase_items(_dirty_messages(spark, sf_dir), extract.LIVE))


def _dirty_items(spark, sf_dir):
    return extract.purchase_items(_dirty_lines(spark, sf_dir), extract.BATCH)


def q_sales_dirty(spark, sf_dir):
    """Prices with many decimals, and numbers beyond the exact range."""
    return reports.sales_by_category(_dirty_items(spark, sf_dir))


def q_popular_items_dirty(spark, sf_dir):
    """A5: a total quantity beyond BIGINT is NULL and fails nothing."""
    return reports.popular_items(_dirty_items(spark, sf_dir), k=10)


def q_order_reconciliation_dirty(spark, sf_dir):
    """Stated amounts against totals of changed prices."""
    events = extract.events(_dirty_lines(spark, sf_dir), extract.BATCH)
    return orders.order_reconciliation(events, _dirty_items(spark, sf_dir))


def q_orphan_counts_dirty(spark, sf_dir):
    """Rows of sessions whose visit was lost (users that are 3 modulo 10)."""
    v, e, i = _batch_tables(spark, sf_dir)
    return quality.orphan_counts({"events": e, "purchase_items": i}, v.where(F.pmod(F.substring("user_id", 5, 20).cast("long"), F.lit(10)) != 3))


def q_orphan_events(spark, sf_dir):
    """Those rows themselves."""
    v, e, _ = _batch_tables(spark, sf_dir)
    lost = v.where(F.pmod(F.substring("user_id", 5, 20).cast("long"), F.lit(10)) != 3)
    return present(reports.orphans(e, lost).select("session_id", "event_unique_id", "timestamp"))


def q_key_report_twice(spark, sf_dir):
    """Tables that both paths appended to."""
    v, e, i = _batch_tables(spark, sf_dir)
    both = {"visits": v.unionByName(landed(spark, sf_dir, "live_visits")), "events": e.unionByName(landed(spark, sf_dir, "live_events")), "purchase_items": i}
    return quality.key_report(both)


def q_session_event_order_reversed(spark, sf_dir):
    """O2: sessions of odd users arrive with their events in reverse."""
    p = landed(spark, sf_dir, "parsed")
    odd = F.pmod(F.substring("rec.user_id", 5, 20).cast("long"), F.lit(2)) == 1
    p = p.withColumn("rec", F.col("rec").withField("events", F.when(odd, F.reverse("rec.events")).otherwise(F.col("rec.events"))))
    x = extract.exploded_events(orders.sort_session_events(p)).where("first_item is null")
    return present(x.select("session_id", "event_pos", "event_type", F.col("ts").alias("timestamp")))


# ------------------------------------------------------------- timestamps

def q_iso_timestamps(spark, sf_dir):
    """Event times written in every form of ISO-8601 that is read, and in some that are not."""
    ts, n = F.col("ts"), F.col("event_id")
    f = lambda pattern: F.date_format(ts, pattern)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    weekday = (F.weekday(ts) + 1).cast("string")
    text = [
        f("yyyyMMdd'T'HHmmss.SSSSSS"), f("yyyy-MM-dd'T'HH:mm:ss,SSSSSS"), f("yyyy-MM-dd'T'HH'Z'"), F.concat(week, F.lit("-"), weekday),
        F.concat(F.replace(week, F.lit("-"), F.lit("")), weekday, F.lit("T"), f("HHmm")), week, f("yyyy-MM-dd HH:mm:ss'+0530'"),
        f("yyyyMMdd'x'HH:mm:ss.SSS'-23:59'"), f("yyyy-MM-dd'T'HH:mm:ss'+01:02:03.5'"), f("yyyy-MM"), F.concat(f("yyyy"), F.lit("-W00-1")),
        f("yyyyMMdd'T'HHmm:ss"), f("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'789Z'"), F.lit("2023-W53-1"), F.lit("2020-W53-7"), f("yyyy-MM-dd'T'HH:mm:ss'+24:00'"),
    ]
    form = F.pmod(n, F.lit(len(text)))
    chosen = F.element_at(F.array(*text), (form + 1).cast("int"))
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", form.alias("form"), parse_iso_timestamp(chosen).alias("read_as"))
    return present(rows)


# --------------------------------------------------------------- messages

def q_push_visits(spark, sf_dir):
    """Messages wrapped as HTTP push envelopes (base64 data), decoded."""
    msgs = session_messages(spark, sf_dir)
    body = F.to_json(F.struct(F.struct(
        F.base64("data").alias("data"),
        F.col("message_id").alias("messageId"),
        F.date_format("publish_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("publishTime"),
        F.map_from_entries("attributes").alias("attributes"),
    ).alias("message"), F.lit("subscriptions/visits").alias("subscription")))
    parsed = decode_push_envelopes(msgs.select(body.alias("body")))
    return present(extract.visits(parsed))


def q_page_views(spark, sf_dir):
    """Page views per 60-minute window on publish time."""
    return present(pageviews.page_view_counts(parsed_messages(spark, sf_dir), window_minutes=PAGE_VIEW_WINDOW_MINUTES))


def q_page_view_alerts(spark, sf_dir):
    """Windows above the alert threshold."""
    counts = pageviews.page_view_counts(parsed_messages(spark, sf_dir), window_minutes=PAGE_VIEW_WINDOW_MINUTES)
    return present(pageviews.page_view_alerts(counts, threshold=ALERT_THRESHOLD))


def q_page_view_flags(spark, sf_dir):
    """T4: every window with its count, the threshold and the alert flag."""
    counts = pageviews.page_view_counts(parsed_messages(spark, sf_dir), window_minutes=PAGE_VIEW_WINDOW_MINUTES)
    return present(pageviews.with_alert_flag(counts, threshold=ALERT_THRESHOLD))


def q_raw_landing_minutes(spark, sf_dir):
    """Raw messages per landing minute."""
    return _per_minute(pageviews.raw_landing_rows(session_records(spark, sf_dir)))


def _per_minute(messages):
    """Sessions that were published in a minute, by their first message."""
    return messages.where(F.col("message_id").endswith("#0")).groupBy("minute").agg(F.count(F.lit(1)).alias("messages"))


# ---------------------------------------------------------------- streaming

def _stream_root(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


def _page_views_run(spark, database, root):
    """Catches up with the messages below ``root``."""
    stream = ingest.message_files_stream(spark, f"{root}/messages/*")
    return ingest.start_page_views(stream, database, f"{root}/checkpoint", PAGE_VIEW_WINDOW_MINUTES, ALERT_THRESHOLD).awaitTermination()


def q_page_views_stream(spark, sf_dir):
    """T1-T3/K3 as a real stream: derived messages land as files, an
    ``availableNow`` query counts them with a zero-lateness watermark; a
    flush message at the end of the input closes the last windows."""
    root, database = _stream_root(spark, "page-views-stream"), _database(spark, "page-views")
    messages = session_messages(spark, sf_dir)
    messages.unionByName(pageviews.flush_message(messages, PAGE_VIEW_WINDOW_MINUTES)).write.parquet(f"{root}/messages/all")
    _page_views_run(spark, database, root)
    return present(spark.table(f"{database}.page_views").select("window_end", "page_view_count"))


def q_late_page_views_stream(spark, sf_dir):
    """Messages of users that are 3 modulo 7 come when all windows
    are closed; what the stream counted and what it rejected as late, by
    window, is what the batch counts. Alerts are those of the counted."""
    root, database = _stream_root(spark, "late-stream"), _database(spark, "late")
    messages = session_messages(spark, sf_dir)
    late = F.pmod(F.regexp_extract("message_id", r"^SID-(\d+)-", 1).cast("long"), F.lit(7)) == 3
    flush = pageviews.flush_message(messages, PAGE_VIEW_WINDOW_MINUTES)
    after = pageviews.flush_message(flush, PAGE_VIEW_WINDOW_MINUTES)
    for i, part in enumerate((messages.where(~late), flush, after, messages.where(late))):
        part.write.parquet(f"{root}/messages/{i}")
        _page_views_run(spark, database, root)
    counted = spark.table(f"{database}.page_views").select("window_end", F.col("page_view_count").alias("on_time"), F.lit(0).cast("long").alias("late"))
    payload = F.from_json("payload", "publish_time string, page_views long")
    rejected = spark.table(f"{database}.rejects").where(F.col("reason") == pageviews.LATE).select(payload.alias("p"))
    end = F.window(F.col("p.publish_time").cast("timestamp"), f"{PAGE_VIEW_WINDOW_MINUTES} minutes")["end"]
    rejected = rejected.select(end.alias("window_end"), F.lit(0).cast("long").alias("on_time"), F.col("p.page_views").alias("late"))
    both = counted.unionByName(rejected).groupBy("window_end").agg(F.sum("on_time").alias("on_time"), F.sum("late").alias("late"))
    alerts = spark.table(f"{database}.page_view_alerts").select("window_end", F.lit(True).alias("is_alert"))
    both = both.where("on_time + late > 0").join(alerts, "window_end", "left")
    return present(both.select("window_end", "on_time", "late", F.coalesce("is_alert", F.lit(False)).alias("is_alert")))


def _database(spark, name: str) -> str:
    """A new database in the shared folder."""
    path = _stream_root(spark, name)
    database = os.path.basename(path).replace("-", "_")
    sinks.provision(spark, database, path)
    return database


def q_events_live_stream(spark, sf_dir):
    """S7/K4 as a real stream: session JSONL files picked up by a file
    stream, decoded and written per micro batch by ``foreachBatch``."""
    root = _stream_root(spark, "live-ingest-stream")
    session_records(spark, sf_dir).select("value").write.text(f"{root}/in")
    lines = ingest.file_sessions_stream(spark, f"{root}/in", glob="*.txt")
    database = _database(spark, "live-tables")
    q = ingest.start_live_ingest(ingest.parse_file_stream(lines), database, f"{root}/checkpoint", profile="live")
    q.awaitTermination()
    return present(spark.table(f"{database}.events").drop("event_date", sinks.LOAD_ID))


def q_visits_of_parts_stream(spark, sf_dir):
    """Records of 2 events, dealt over micro batches by chance, with one
    batch replayed: the parts that the batches wrote merge to the visits."""
    root, database = _stream_root(spark, "parts-stream"), _database(spark, "parts")
    messages = session_messages(spark, sf_dir, *SMALL_BOUNDS)
    shares = [messages.where(F.pmod(F.xxhash64("message_id"), F.lit(PARTS_BATCHES)) == i) for i in range(PARTS_BATCHES)]
    for i, share in enumerate(shares):
        share.write.parquet(f"{root}/messages/{i}")
        stream = parse_messages(ingest.message_files_stream(spark, f"{root}/messages/*"))
        ingest.start_live_ingest(stream, database, f"{root}/checkpoint").awaitTermination()
    ingest.write_batch_tables(parse_messages(shares[0]), database, 0)
    return present(spark.table(f"{database}.visits").drop("visit_date", sinks.LOAD_ID))


def q_live_job_runs(spark, sf_dir):
    """A10/K7: what the loads of a stream reported of themselves, summed over its batches."""
    root, database = _stream_root(spark, "runs-stream"), _database(spark, "runs")
    messages = session_messages(spark, sf_dir)
    for i in range(2):
        messages.where(F.pmod(F.xxhash64("message_id"), F.lit(2)) == i).write.parquet(f"{root}/messages/{i}")
        stream = parse_messages(ingest.message_files_stream(spark, f"{root}/messages/*"))
        ingest.start_live_ingest(stream, database, f"{root}/checkpoint").awaitTermination()
    runs = spark.table(f"{database}.job_runs").select("job_name", F.explode("metrics").alias("metric", "value"))
    return runs.groupBy("job_name", "metric").agg(F.sum("value").alias("value"))


def _landed_raw(spark, messages):
    root = _stream_root(spark, "raw-landing-stream")
    messages.write.parquet(f"{root}/messages")
    q = ingest.start_raw_landing(ingest.message_files_stream(spark, f"{root}/messages"), f"{root}/raw",
                                 f"{root}/checkpoint")
    q.awaitTermination()
    return pageviews.read_raw_landing(spark, f"{root}/raw")


def q_raw_landing_messages(spark, sf_dir):
    """Messages without a publish time (users divisible by 5) and with a
    repeated header (odd users) land and come back with all they had; the shard
    of each is the one that its id gives."""
    user = F.regexp_extract("message_id", r"^SID-(\d+)-", 1).cast("long")
    header = lambda v: F.struct(F.lit("h").alias("key"), F.lit(v).alias("value"))
    messages = session_messages(spark, sf_dir).withColumns({
        "publish_time": F.when(user % 5 != 0, F.col("publish_time")),
        "attributes": F.when(user % 2 == 1, F.concat("attributes", F.array(header("b"), header("a")))).otherwise(F.col("attributes")),
    })
    back = _landed_raw(spark, messages).where(F.col("message_id").endswith("#0"))
    values = F.transform(F.filter("attributes", lambda a: a["key"] == "h"), lambda a: a["value"])
    return present(back.select(
        "message_id", "publish_time", F.size("attributes").alias("n_attributes"), F.array_join(values, ",").alias("headers"),
        F.col("shard").eqNullSafe(shard_label("message_id", pageviews.DEFAULT_NUM_SHARDS)).alias("in_its_shard"),
        F.length("data").cast("long").alias("n_bytes") > 0,
    ).toDF("message_id", "publish_time", "n_attributes", "headers", "in_its_shard", "has_data"))


def q_raw_landing_stream(spark, sf_dir):
    """K5/X7/X10 as a real stream: messages landed as lines of text files,
    read back and counted per minute."""
    return _per_minute(_landed_raw(spark, session_messages(spark, sf_dir)))


def q_raw_landing_round_trip(spark, sf_dir):
    """Messages with defects, line feeds and bytes that are no text
    among them, land and are decoded again without loss."""
    back = _landed_raw(spark, dirty.dirty_messages(landed(spark, sf_dir, "parsed")))
    return _reject_rows(parse_messages(back.select("message_id", "publish_time", "attributes", "data")), extract.LIVE)


# -------------------------------------------------------------------- loads

def _files(spark, records) -> str:
    path = _stream_root(spark, "session-files")
    records.select("value").write.text(path)
    return path


def _halves_of(spark, sf_dir):
    """Records of even and of odd users."""
    rec = session_records(spark, sf_dir)
    odd = F.pmod(F.regexp_extract("message_id", r"^SID-(\d+)-", 1).cast("long"), F.lit(2)) == 1
    return rec.where(~odd), rec.where(odd)


def _halves(spark, sf_dir):
    """The same as two folders of files."""
    return tuple(_files(spark, rec) for rec in _halves_of(spark, sf_dir))


def _batch(spark, path, database, **kw):
    return run_batch(spark, path, database=database, glob="*.txt", **kw)


def q_tables_after_replay(spark, sf_dir):
    """Two batch loads, the first of them run again with its id
    after the second; every session is there once."""
    even, odd = _halves(spark, sf_dir)
    database = _database(spark, "replay")
    for path, run in ((even, "1"), (odd, "2"), (even, "1")):
        _batch(spark, path, database, run_id=run)
    return present(spark.table(f"{database}.visits").drop("visit_date", sinks.LOAD_ID))


def q_tables_of_both_paths(spark, sf_dir):
    """A batch load of even users and a live load of odd users, with
    a replayed micro batch, in the same tables: rows per table and type of load."""
    even, odd = _halves(spark, sf_dir)
    database = _database(spark, "both")
    _batch(spark, even, database, run_id="1")
    parsed = parse_sessions(read_jsonl(spark, odd, glob="*.txt"))
    for _ in range(2):
        ingest.write_batch_tables(parsed, database, 0)
    kind = F.substring_index(sinks.LOAD_ID, "-", 1).alias("load")
    rows = [spark.table(f"{database}.{t}").select(F.lit(t).alias("table_name"), kind) for t in ("visits", "events", "purchase_items", "rejects")]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name", "load").agg(F.count(F.lit(1)).alias("row_count"))


def q_loads_without_copies(spark, sf_dir):
    """A batch load of even users; a live load of users divisible by 3 and a batch
    load of all, run twice, each without rows that are there: who wrote which rows of a session."""
    even = _files(spark, _halves_of(spark, sf_dir)[0])
    database = _database(spark, "no-copies")
    _batch(spark, even, database, run_id="1")
    user = F.regexp_extract("message_id", r"^SID-(\d+)-", 1).cast("long")
    ingest.write_batch_tables(parse_messages(session_messages(spark, sf_dir).where(user % 3 == 0)), database, 0, skip_known=True)
    everything = _files(spark, session_records(spark, sf_dir))
    for _ in range(2):
        _batch(spark, everything, database, run_id="2", skip_known=True)
    rows = [spark.table(f"{database}.{t}").groupBy("session_id", sinks.LOAD_ID).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "*") for t in ("visits", "events", "purchase_items")]
    return reduce(DataFrame.unionByName, rows)


def q_joins_by_session(spark, sf_dir):
    """J1/J2/J4 on tables laid out by session, where sessions of more than 2 rows are split:
    what the three joins say of each session. A state published before is replaced."""
    database = _database(spark, "by-session")
    even = _files(spark, _halves_of(spark, sf_dir)[0])
    _batch(spark, even, database, run_id="1")
    by_session.publish(spark, database, 4, SPLIT_ROWS)
    v, e, i = _batch_tables(spark, sf_dir)
    by_session.publish(spark, database, 8, SPLIT_ROWS, {"visits": v, "events": e, "purchase_items": i})
    count = F.count(F.lit(1)).alias("n")
    j1 = by_session.events_with_visit(spark, database).groupBy("session_id").agg(count, F.min("visit_start").alias("visit_start"), F.sum("visit_event_count").alias("value"))
    j2 = by_session.items_with_visit(spark, database).groupBy("session_id").agg(count, F.min("visit_start").alias("visit_start"), F.sum(F.length("device_type")).alias("value"))
    j4 = by_session.sessions_with_purchase(spark, database).groupBy("session_id").agg(count, F.min("start_timestamp").alias("visit_start"), F.sum("event_count").alias("value"))
    return present(reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("join_name"), "*") for name, df in (("J1", j1), ("J2", j2), ("J4", j4))]))


def q_days_replaced(spark, sf_dir):
    """K1: all sessions loaded, then the days that are 3 modulo 10 loaded
    again with even users only, in place of what was there."""
    rec = session_records(spark, sf_dir)
    day = F.regexp_extract("message_id", r"^SID-(\d+)-\d{6}(\d\d)", 2).cast("int") % 10 == 3
    even = F.pmod(F.regexp_extract("message_id", r"^SID-(\d+)-", 1).cast("long"), F.lit(2)) == 0
    database = _database(spark, "days")
    _batch(spark, _files(spark, rec), database)
    _batch(spark, _files(spark, rec.where(day & even)), database, mode=sinks.REPLACE_DAYS)
    rows = [spark.table(f"{database}.{t}").select(F.lit(t).alias("table_name"), F.col(c).cast("string").alias("day")) for t, c in (("visits", "visit_date"), ("events", "event_date"), ("purchase_items", "order_date"))]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name", "day").agg(F.count(F.lit(1)).alias("row_count"))


def q_tables_truncated(spark, sf_dir):
    """K1: all sessions, then odd users in place of everything."""
    _, odd = _halves(spark, sf_dir)
    database = _database(spark, "truncated")
    _batch(spark, _files(spark, session_records(spark, sf_dir)), database)
    _batch(spark, odd, database, mode=sinks.TRUNCATE)
    rows = [spark.table(f"{database}.{t}").select(F.lit(t).alias("table_name")) for t in ("visits", "events", "purchase_items", "rejects")]
    return reduce(DataFrame.unionByName, rows).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


def _counts(spark, database, state):
    tables = ("visits", "events", "purchase_items", "rejects")
    return reduce(DataFrame.unionByName, [spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(state).alias("state"), F.lit(t).alias("table_name"), "row_count") for t in tables])


def q_failed_load(spark, sf_dir):
    """A load of odd users fails between two tables: every table shows
    even users only; it is tried again: every table shows all."""
    even, odd = _halves(spark, sf_dir)
    database = _database(spark, "failed")
    _batch(spark, even, database, run_id="1")

    def lose(name):
        if name == "events":
            raise OSError("lost between two tables")

    try:
        _batch(spark, odd, database, run_id="2", after_table=lose)
    except OSError:
        before = staged(_counts(spark, database, "failed"), "counts")
    _batch(spark, odd, database, run_id="2")
    return before.unionByName(_counts(spark, database, "retried"))


def q_archived_once(spark, sf_dir):
    """A run commits and is stopped while it archives; the next run finds
    a new file beside what is left, loads that alone, and archives all."""
    root, database = _stream_root(spark, "ledger"), _database(spark, "ledger")
    even, odd = (r.select("value") for r in _halves_of(spark, sf_dir))
    even.repartition(7).write.text(f"{root}/in/even")

    def stop(name):
        raise OSError("stopped while archiving")

    for _ in range(2):
        try:
            _batch(spark, f"{root}/in/*", database, run_id="1", archive_dir=f"{root}/archive", after_file=stop)
        except OSError:
            pass
    odd.repartition(3).write.text(f"{root}/in/odd")
    _batch(spark, f"{root}/in/*", database, run_id="2", archive_dir=f"{root}/archive")
    count = lambda df, what: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(what).alias("what"), "n")
    files = lambda path: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path).select("length")
    rows = [count(spark.table(f"{database}.{t}"), t) for t in ("visits", "events", "purchase_items")]
    rows += [count(files(f"{root}/in"), "left"), count(files(f"{root}/archive"), "archived"), count(spark.table(f"{database}.files").select("path").distinct(), "loaded")]
    return reduce(DataFrame.unionByName, rows)


def _one_of_two(lines):
    """A decoder that takes a line which says the same record twice as that record."""
    half = F.substring("value", F.lit(1), F.floor((F.length("value") - 1) / 2).cast("int"))
    return parse_sessions(lines.withColumn("value", F.when(F.concat(half, F.lit(" "), half) == F.col("value"), half).otherwise(F.col("value"))))


def q_curated_from_raw(spark, sf_dir):
    """Lines with defects of even, then of odd users are landed raw and derived as they come;
    a new version of the decoder, which mends one kind of defect, derives both again. A run that
    fails before its commit changes nothing. Rows by table and session, after each step."""
    database, raw = _database(spark, "derived"), _database(spark, "derived-raw")
    lines = staged(dirty.dirty_records(landed(spark, sf_dir, "parsed")).select("value", F.col("message_id").alias("source"), "user"), "lines")
    out = []

    def state(name, metrics):
        versions = decoder_versions(spark, database)
        for t in ("visits", "events", "purchase_items", "rejects"):
            number = F.sum("event_count") if t == "visits" else F.count(F.lit(1))
            rows = with_decoder_version(spark, t, database, versions).groupBy("session_id", "decoder_version").agg(number.cast("long").alias("n"))
            out.append(staged(rows.select(F.lit(name).alias("state"), F.lit(t).alias("table_name"), "session_id", "decoder_version", "n"), "state"))
        done = spark.range(1).select(F.lit(name).alias("state"), F.lit("derived").alias("table_name"), F.lit(None).cast("string").alias("session_id"), F.lit(None).cast("long").alias("decoder_version"), F.lit(metrics.get("derivations_rows", 0)).cast("long").alias("n"))
        out.append(done)

    def lose(name):
        if name == "events":
            raise OSError("lost between two tables")

    sinks.land_raw(lines.where("user % 2 = 0"), raw, "even")
    first = derive(spark, database, raw)
    sinks.land_raw(lines.where("user % 2 = 1"), raw, "odd")
    derive(spark, database, raw)
    try:
        derive(spark, database, raw, _one_of_two, 2, after_table=lose)
    except OSError:
        state("landed", first)
    sinks.compact(spark, sinks.RAW_SESSIONS, raw, "2999-01-01")
    again = derive(spark, database, raw, _one_of_two, 2)
    derive(spark, database, raw)  # an older decoder leaves newer rows alone
    state("decoded again", again)
    return reduce(DataFrame.unionByName, out)


def q_compacted_tables(spark, sf_dir):
    """Four live loads of parts and whole records, compacted: a day of a table
    is one load, no row is lost, and what is hidden is vacuumed."""
    database = _database(spark, "compacted")
    messages = session_messages(spark, sf_dir, *SMALL_BOUNDS)
    for i in range(4):
        ingest.write_batch_tables(parse_messages(messages.where(F.pmod(F.xxhash64("message_id"), F.lit(4)) == i)), database, i)
    for t in ("visits", "events", "purchase_items", "rejects"):
        sinks.compact(spark, t, database, "2999-01-01")
    sinks.vacuum(spark, database, 0)
    out = []
    for t in ("visits", "events", "purchase_items", "rejects"):
        day, rows = sinks.PARTITION_COLUMNS[t][0], spark.table(f"{database}.{t}")
        loads = spark.table(f"{database}.{t}_rows").groupBy(day).agg(F.count_distinct(sinks.ATTEMPT).alias("n")).agg(F.max("n").alias("most_loads_a_day"))
        out.append(rows.agg(F.count(F.lit(1)).alias("row_count")).crossJoin(loads).select(F.lit(t).alias("table_name"), "row_count", "most_loads_a_day"))
    return reduce(DataFrame.unionByName, out)


def q_job_run_metrics(spark, sf_dir):
    """K6, K7, A10: what a run of lines with defects reports, and what it leaves in its input folder."""
    path = _files(spark, dirty.dirty_records(landed(spark, sf_dir, "parsed")).where("value not rlike '^\n'"))
    database = _database(spark, "metrics")
    _batch(spark, path, database, archive_dir=_stream_root(spark, "archive"))
    left = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).agg(F.count(F.lit(1)).alias("n"))
    runs = spark.table(f"{database}.job_runs").select("status", F.explode("metrics").alias("metric", "value"))
    return runs.unionByName(left.select(F.lit("LEFT").alias("status"), F.lit("files").alias("metric"), F.col("n").alias("value")))


def q_live_dashboard_stream(spark, sf_dir):
    """The reports as streams over messages that are delivered twice, of
    sessions cut into records of 2 events. Replays are dropped and messages decoded
    once for all reports. All messages come in one batch, so none is late; the
    logs are compacted before they are read."""
    root = _stream_root(spark, "dashboard")
    messages = session_messages(spark, sf_dir, *SMALL_BOUNDS)
    messages.unionByName(messages).write.parquet(f"{root}/messages")
    # no report reads attributes; the replay filter need not shuffle them
    stream = ingest.without_replays(ingest.message_files_stream(spark, f"{root}/messages").drop("attributes"), ingest.DASHBOARD_LATENESS)
    ingest.start_decoded(parse_messages(stream), f"{root}/decoded", f"{root}/ck-decoded").awaitTermination()
    running, out = [], []
    try:  # the reports' streams run side by side
        for name in ingest.DASHBOARD:
            running.append(ingest.start_updates(ingest.live_dashboard_aggregates(ingest.decoded_stream(spark, f"{root}/decoded"))[name], f"{root}/{name}", f"{root}/ck-{name}"))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
    for name, (key, _) in ingest.DASHBOARD.items():
        ingest.compact_updates(spark, f"{root}/{name}", ["day", key], keep_batches=0)
        report = ingest.read_dashboard(spark, f"{root}/{name}", name)
        value = [c for c in report.columns if c != key][0]
        out.append(report.select(F.lit(name).alias("report"), F.col(key).alias("group_key"), F.col(value).cast("double").alias("value")))
    return reduce(DataFrame.unionByName, out)


# Report parameters: at sf0.01 a minute holds a handful of events, so the
# registered window reports use hour windows and a matching threshold.
PAGE_VIEW_WINDOW_MINUTES = 60
ALERT_THRESHOLD = 5
# Events a record and items a record where sessions are to be cut, and batches they are dealt over.
SMALL_BOUNDS = (2, 3)
SPLIT_ROWS = 2
PARTS_BATCHES = 3


def _in_utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run a query with the session time zone the semantics assume (UTC).

    Offset-less ISO timestamps are UTC (SURVEY §1) and windows are
    epoch-aligned in UTC; a caller's session may default to another zone.
    """
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "visits_by_page": q_visits_by_page,
    "visits": q_visits,
    "events_batch": q_events_batch,
    "events_live": q_events_live,
    "purchase_items_batch": q_purchase_items_batch,
    "purchase_items_live": q_purchase_items_live,
    "rejects_batch": q_rejects_batch,
    "rejects_live": q_rejects_live,
    "visits_by_device": q_visits_by_device,
    "popular_items": q_popular_items,
    "sales_by_category": q_sales_by_category,
    "events_with_visit": q_events_with_visit,
    "items_with_visit": q_items_with_visit,
    "orphan_counts": q_orphan_counts,
    "sessions_with_purchase": q_sessions_with_purchase,
    "key_report": q_key_report,
    "dedup_visits": q_dedup_visits,
    "union_paths_events": q_union_paths_events,
    "path_reconciliation": q_path_reconciliation,
    "profile_diff": q_profile_diff,
    "order_amounts": q_order_amounts,
    "order_reconciliation": q_order_reconciliation,
    "cart_before_purchase": q_cart_before_purchase,
    "session_event_order": q_session_event_order,
    "reassembled_visits": q_reassembled_visits,
    "push_visits": q_push_visits,
    "page_views": q_page_views,
    "page_view_alerts": q_page_view_alerts,
    "raw_landing_minutes": q_raw_landing_minutes,
    "page_views_stream": q_page_views_stream,
    "duplicate_visit_keys": q_duplicate_visit_keys,
    "consolidated_visits": q_consolidated_visits,
    "page_view_flags": q_page_view_flags,
    "events_live_stream": q_events_live_stream,
    "raw_landing_stream": q_raw_landing_stream,
    "rejects_dirty_batch": q_rejects_dirty_batch,
    "rejects_dirty_live": q_rejects_dirty_live,
    "visits_dirty": q_visits_dirty,
    "events_dirty": q_events_dirty,
    "items_dirty_batch": q_items_dirty_batch,
    "items_dirty_live": q_items_dirty_live,
    "sales_dirty": q_sales_dirty,
    "popular_items_dirty": q_popular_items_dirty,
    "order_reconciliation_dirty": q_order_reconciliation_dirty,
    "orphan_counts_dirty": q_orphan_counts_dirty,
    "orphan_events": q_orphan_events,
    "key_report_twice": q_key_report_twice,
    "session_event_order_reversed": q_session_event_order_reversed,
    "raw_landing_round_trip": q_raw_landing_round_trip,
    "tables_after_replay": q_tables_after_replay,
    "tables_of_both_paths": q_tables_of_both_paths,
    "days_replaced": q_days_replaced,
    "tables_truncated": q_tables_truncated,
    "job_run_metrics": q_job_run_metrics,
    "live_dashboard_stream": q_live_dashboard_stream,
    "iso_timestamps": q_iso_timestamps,
    "consolidated_parts": q_consolidated_parts,
    "visits_of_parts_stream": q_visits_of_parts_stream,
    "late_page_views_stream": q_late_page_views_stream,
    "raw_landing_messages": q_raw_landing_messages,
    "live_job_runs": q_live_job_runs,
    "failed_load": q_failed_load,
    "compacted_tables": q_compacted_tables,
    "archived_once": q_archived_once,
    "curated_from_raw": q_curated_from_raw,
    "loads_without_copies": q_loads_without_copies,
    "joins_by_session": q_joins_by_session,
}

QUERIES = {name: _in_utc(fn) for name, fn in QUERIES.items()}
