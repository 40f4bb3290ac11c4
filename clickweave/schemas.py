"""Input and output schemas.

Input: every leaf of the session record is declared STRING and converted
later with ``try_cast``. With typed leaves a single wrong-typed value
(``"price": "9.5"``) would silently null the field; strings keep the raw
text so the conversion rules are ours.

Output: the writer schemas of the batch/live jobs (16 columns for
``events``, 9 for ``purchase_items``), with REQUIRED columns as
``nullable=False``. Spark's Parquet sink does not enforce NOT NULL, so
the extractors filter those rows into the rejects table instead.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

ITEM_FIELDS = ["product_id", "product_name", "category", "price", "quantity"]
DETAIL_FIELDS = [
    "page_url", "referrer_url", "product_id", "product_name", "category",
    "price", "quantity", "order_id", "amount", "currency",
]
VISIT_SCALARS = ["session_id", "user_id", "device_type", "geolocation", "user_agent"]

CORRUPT_COL = "_corrupt_record"


def _strings(names):
    return [T.StructField(n, S) for n in names]


ITEM = T.StructType(_strings(ITEM_FIELDS))
DETAILS = T.StructType(_strings(DETAIL_FIELDS) + [T.StructField("items", T.ArrayType(ITEM))])
EVENT = T.StructType([
    T.StructField("event_type", S),
    T.StructField("timestamp", S),
    T.StructField("details", DETAILS),
])
EVENT_ENTRY = T.StructType([T.StructField("event", EVENT)])
# Optional members of a record that holds a range of a long session (see
# sources.derived): which of how many parts it is, the position of its first
# entry in the session, and, if its only entry continues the items of a
# purchase, the position of its first item in the order.
PART_FIELDS = ["part", "parts", "first_event_pos", "first_item_pos"]
SESSION = T.StructType(_strings(VISIT_SCALARS + PART_FIELDS) + [T.StructField("events", T.ArrayType(EVENT_ENTRY))])
SESSION_PARSE = T.StructType(SESSION.fields + [T.StructField(CORRUPT_COL, S)])

# A decoded record as it is handed on between streams.
DECODED = T.StructType([
    T.StructField("message_id", S),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("rec", SESSION),
    T.StructField("reject_reason", S),
])

# Message envelope pushed over HTTP: {"message": {...}, "subscription": ...}
PUSH_ENVELOPE = T.StructType([
    T.StructField("message", T.StructType([
        T.StructField("data", S),
        T.StructField("messageId", S),
        T.StructField("message_id", S),
        T.StructField("publishTime", S),
        T.StructField("publish_time", S),
        T.StructField("attributes", T.MapType(S, S)),
    ])),
    T.StructField("subscription", S),
    T.StructField(CORRUPT_COL, S),
])

# Attributes of a message, in order; a key may be there several times.
ATTRIBUTES = T.ArrayType(T.StructType([T.StructField("key", S), T.StructField("value", S)]))

# Normalised message stream (pull, streaming, Kafka all map onto this).
MESSAGE = T.StructType([
    T.StructField("message_id", S, False),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("attributes", ATTRIBUTES),
    T.StructField("data", T.BinaryType()),
])


def _f(name, dtype, nullable=True, comment=None):
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


VISITS = T.StructType([
    _f("session_id", S, False, "session key"),
    _f("user_id", S),
    _f("device_type", S),
    _f("geolocation", S, comment="lat,lon"),
    _f("user_agent", S),
    _f("start_timestamp", T.TimestampType(), comment="earliest parseable event time"),
    _f("end_timestamp", T.TimestampType(), comment="latest parseable event time"),
    _f("event_count", T.LongType(), comment="raw entries in the events array"),
])

# What is stored of visits: a row per session record.
VISIT_PARTS = T.StructType(VISITS.fields + [
    _f("part", T.LongType(), comment="number of the part, NULL for a whole session"),
    _f("parts", T.LongType(), comment="parts of the session, NULL for a whole one"),
])

EVENTS = T.StructType([
    _f("session_id", S, False, "FK visits.session_id"),
    _f("event_unique_id", S, False, "deterministic hash of session, position, type, time"),
    _f("event_type", S, False),
    _f("timestamp", T.TimestampType(), False),
    _f("page_url", S),
    _f("referrer_url", S),
    _f("product_id", S),
    _f("product_name", S),
    _f("category", S),
    _f("price", T.DoubleType()),
    _f("quantity", T.LongType()),
    _f("order_id", S),
    _f("amount", T.DoubleType()),
    _f("currency", S),
    _f("device_type", S),
    _f("user_id", S),
])

PURCHASE_ITEMS = T.StructType([
    _f("order_id", S, False),
    _f("item_index_in_order", T.LongType(), False, "0-based position before filtering"),
    _f("session_id", S, False, "FK visits.session_id"),
    _f("product_id", S, False),
    _f("product_name", S),
    _f("category", S),
    _f("price", T.DoubleType()),
    _f("quantity", T.LongType()),
    _f("purchase_event_timestamp", T.TimestampType()),
])

PAGE_VIEWS = T.StructType([
    _f("window_end", T.TimestampType(), False, "exclusive window end"),
    _f("page_view_count", T.LongType(), False),
])

PAGE_VIEW_ALERTS = T.StructType(PAGE_VIEWS.fields + [_f("threshold", T.LongType(), False)])

REJECTS = T.StructType([
    _f("source", S, comment="file path or message id"),
    _f("stage", S, False, "record | event | item"),
    _f("reason", S, False),
    _f("session_id", S),
    _f("event_pos", T.IntegerType()),
    _f("item_pos", T.IntegerType()),
    _f("payload", S),
])

JOB_RUNS = T.StructType([
    _f("job_name", S, False),
    _f("run_id", S, False),
    _f("finished_at", T.TimestampType(), False),
    _f("status", S, False),
    _f("source", S),
    _f("destination", S),
    _f("metrics", T.MapType(S, T.LongType())),
])

# The ledger of input files: those that committed loads have read.
FILES = T.StructType([
    _f("path", S, False),
    _f("length", T.LongType()),
    _f("modified", T.TimestampType()),
])

# What has been derived of the raw zone: a row a landing.
DERIVATIONS = T.StructType([
    _f("landing", S, False, "load that landed the lines in the raw zone"),
    _f("landing_attempt", S, False, "attempt of that load whose lines were decoded"),
    _f("decoder_version", T.LongType(), False),
])

# Raw zone: input lines as received.
SESSIONS_RAW = T.StructType([
    _f("value", S),
    _f("source", S),
    _f("landed_at", T.TimestampType()),
])

TABLES = {
    "visits": VISITS,
    "events": EVENTS,
    "purchase_items": PURCHASE_ITEMS,
    "page_views": PAGE_VIEWS,
    "rejects": REJECTS,
    "job_runs": JOB_RUNS,
    "files": FILES,
    "derivations": DERIVATIONS,
    "sessions_raw": SESSIONS_RAW,
}

PRIMARY_KEYS = {
    "visits": ["session_id"],
    "events": ["session_id", "event_unique_id"],
    "purchase_items": ["order_id", "item_index_in_order"],
    "page_views": ["window_end"],
}


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE with NOT NULL and COMMENT clauses."""
    cols = []
    for f in schema.fields:
        piece = f"`{f.name}` {f.dataType.simpleString().upper()}"
        if not f.nullable:
            piece += " NOT NULL"
        if f.metadata.get("comment"):
            text = f.metadata["comment"].replace("'", "\\'")
            piece += f" COMMENT '{text}'"
        cols.append(piece)
    return ", ".join(cols)
