"""Flattening of parsed session records.

All extractors are narrow transformations of the parsed frame
(``sources.decode.parse_sessions``): projections, higher-order array
functions and ``posexplode``. None of them shuffles, so they scale with
the number of input splits and run inside one codegen stage per scan.

Two profiles exist because the reference has two writers with different
rules (SURVEY §4.3):

* ``batch`` - every event with a type and a timestamp is an ``events``
  row, purchases and unknown types included; purchase items do not need
  an event timestamp.
* ``live`` - only the six browsing types are ``events`` rows; purchases
  only feed ``purchase_items`` and need a timestamp; other types are
  rejected.

Deliberate differences from the reference (SURVEY §4.4): a NULL
``events``/``event``/``details`` counts as empty instead of failing the
record; an unparseable timestamp rejects the event (the column is NOT
NULL) instead of failing at the sink; the event id is a content hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.functions.scalars import (
    bad_number,
    event_unique_id,
    is_missing,
    parse_iso_timestamp,
    present,
    to_bigint,
    to_double,
)
from clickweave.schemas import DETAIL_FIELDS

BATCH = "batch"
LIVE = "live"
PROFILES = (BATCH, LIVE)

# Event types the live writers accept as events rows.
LIVE_EVENT_TYPES = [
    "page_view", "add_item_to_cart", "remove_item_from_cart", "view_item", "promo_view", "promo_click",
]
PURCHASE = "purchase"

# Reject reasons below record level.
MISSING_TYPE_OR_TIMESTAMP = "missing_type_or_timestamp"
BAD_TIMESTAMP = "bad_timestamp"
UNKNOWN_EVENT_TYPE = "unknown_event_type"
MISSING_ORDER_ID = "missing_order_id"
MISSING_PRODUCT_ID = "missing_product_id"
MISSING_REQUIRED = "missing_required_field"
BAD_NUMBER = "bad_number"


def _check_profile(profile: str) -> None:
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, got {profile!r}")


def _events_array(rec: Column) -> Column:
    """``events`` with NULL read as an empty array."""
    return F.coalesce(rec["events"], F.array())


def _good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull())


def _first(rec: Column, name: str) -> Column:
    """A part's offset (0 for a whole record)."""
    return F.coalesce(rec[name].try_cast("long"), F.lit(0).cast("long"))


def visit_parts(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per usable record, without explode or shuffle (``schemas.VISIT_PARTS``, and columns to ``keep``).

    ``start``/``end`` are the min/max of the *parseable* event timestamps
    (``array_min``/``array_max`` skip NULLs). ``event_count`` is the length
    of the raw events array, invalid entries included. ``part`` and ``parts``
    are those of a record that is a part of a long session, else NULL.
    Records that continue the items of a purchase are no visit.
    """
    rec = F.col("rec")
    evs = _events_array(rec)
    ts = F.transform(evs, lambda e: parse_iso_timestamp(e["event"]["timestamp"]))
    return _good(parsed).where(rec["first_item_pos"].isNull()).select(
        rec["session_id"].alias("session_id"),
        rec["user_id"].alias("user_id"),
        rec["device_type"].alias("device_type"),
        rec["geolocation"].alias("geolocation"),
        rec["user_agent"].alias("user_agent"),
        F.array_min(ts).alias("start_timestamp"),
        F.array_max(ts).alias("end_timestamp"),
        F.size(evs).cast("long").alias("event_count"),
        F.when(rec["parts"].isNotNull(), F.coalesce(rec["part"].try_cast("long"), F.lit(0))).alias("part"),
        rec["parts"].try_cast("long").alias("parts"),
        *(keep or []),
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    """Visits of visit parts, whichever records and loads the parts came in.

    A part that is there several times counts once; then parts merge by
    minimum, maximum and sum, so their order does not matter. Whole records
    are not shuffled.
    """
    columns = [c for c in parts.columns if c not in ("part", "parts")]
    rest = [c for c in columns if c != "session_id"]
    once = parts.where("part is not null").groupBy("session_id", "part").agg(*(F.min(c).alias(c) for c in rest))
    merged = once.groupBy("session_id").agg(*(F.min(c).alias(c) for c in rest if c not in ("end_timestamp", "event_count")), F.max("end_timestamp").alias("end_timestamp"), F.sum("event_count").alias("event_count"))
    return parts.where("part is null").select(*columns).unionByName(merged)


def visits(parsed: DataFrame) -> DataFrame:
    """One visit row per session, parts merged (only their rows are shuffled)."""
    return merge_parts(visit_parts(parsed))


def exploded_events(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per raw event entry with its 0-based position in the session.

    Adds ``event_type``, ``ts_text``, ``ts``, ``details`` and ``first_item``
    (NULL, or where the items of a continued purchase start); no filtering
    yet.
    """
    keep = keep or []
    rec = F.col("rec")
    out = _good(parsed).select(
        *keep,
        rec["session_id"].alias("session_id"),
        rec["user_id"].alias("user_id"),
        rec["device_type"].alias("device_type"),
        _first(rec, "first_event_pos").alias("_first"),
        rec["first_item_pos"].try_cast("long").alias("first_item"),
        F.posexplode(_events_array(rec)).alias("_pos", "entry"),
    )
    ev = F.col("entry.event")
    return out.select(
        *keep, "session_id", "user_id", "device_type", (F.col("_first") + F.col("_pos")).cast("int").alias("event_pos"),
        "first_item", "entry",
        ev["event_type"].alias("event_type"),
        ev["timestamp"].alias("ts_text"),
        parse_iso_timestamp(ev["timestamp"]).alias("ts"),
        ev["details"].alias("details"),
    )


def _event_reason(profile: str) -> Column:
    """Why an exploded event is not an ``events`` row (NULL: it is one)."""
    et, tt, ts = F.col("event_type"), F.col("ts_text"), F.col("ts")
    reason = F.when(is_missing(et) | is_missing(tt), F.lit(MISSING_TYPE_OR_TIMESTAMP)).when(
        ts.isNull(), F.lit(BAD_TIMESTAMP)
    )
    d = F.col("details")
    reason = reason.when(bad_number(d["price"]) | bad_number(d["quantity"]) | bad_number(d["amount"]), F.lit(BAD_NUMBER))
    if profile == LIVE:
        reason = reason.when(~et.isin(LIVE_EVENT_TYPES + [PURCHASE]), F.lit(UNKNOWN_EVENT_TYPE))
    return reason


def events(parsed: DataFrame, profile: str = BATCH, keep: list[str] | None = None) -> DataFrame:
    """P2 (batch) / P4 (live): the flat ``events`` table, and columns of the record to ``keep``."""
    _check_profile(profile)
    x = exploded_events(parsed, keep).where(F.col("first_item").isNull())
    cond = _event_reason(profile).isNull()
    if profile == LIVE:
        cond = cond & F.col("event_type").isin(LIVE_EVENT_TYPES)
    d = F.col("details")
    detail = {name: d[name] for name in DETAIL_FIELDS}
    return x.where(cond).select(
        "session_id",
        event_unique_id(F.col("session_id"), F.col("event_pos"), F.col("event_type"), F.col("ts_text")).alias(
            "event_unique_id"
        ),
        "event_type",
        F.col("ts").alias("timestamp"),
        detail["page_url"].alias("page_url"),
        detail["referrer_url"].alias("referrer_url"),
        detail["product_id"].alias("product_id"),
        detail["product_name"].alias("product_name"),
        detail["category"].alias("category"),
        to_double(detail["price"]).alias("price"),
        to_bigint(detail["quantity"]).alias("quantity"),
        detail["order_id"].alias("order_id"),
        to_double(detail["amount"]).alias("amount"),
        detail["currency"].alias("currency"),
        "device_type",
        "user_id",
        *(keep or []),
    )


def _purchase_reason(profile: str) -> Column:
    """Why a purchase event yields no items (NULL: it yields its items)."""
    order_id = F.col("details.order_id")
    if profile == BATCH:
        return F.when(is_missing(order_id), F.lit(MISSING_ORDER_ID))
    return F.when(is_missing(F.col("ts_text")), F.lit(MISSING_TYPE_OR_TIMESTAMP)).when(
        F.col("ts").isNull(), F.lit(BAD_TIMESTAMP)
    ).when(is_missing(order_id), F.lit(MISSING_ORDER_ID))


def exploded_items(parsed: DataFrame, profile: str = BATCH, keep: list[str] | None = None) -> DataFrame:
    """Purchase items with position, before the per-item checks."""
    _check_profile(profile)
    x = exploded_events(parsed, keep).where(F.col("event_type") == PURCHASE)
    x = x.where(_purchase_reason(profile).isNull())
    return x.select(
        *(keep or []), "session_id", "event_pos", "ts",
        F.col("details.order_id").alias("order_id"),
        F.coalesce("first_item", F.lit(0).cast("long")).alias("_first"),
        F.posexplode(F.coalesce(F.col("details.items"), F.array())).alias("_pos", "item"),
    ).withColumn("item_pos", F.col("_first") + F.col("_pos")).drop("_first", "_pos")


def _item_reason(profile: str, item: Column, order_id: Column) -> Column:
    """Why an item is no row (NULL: it is one)."""
    reason = F.when(item["product_id"].isNull(), F.lit(MISSING_PRODUCT_ID))
    if profile == LIVE:
        reason = reason.when(F.col("session_id").isNull() | order_id.isNull(), F.lit(MISSING_REQUIRED))
    return reason.when(bad_number(item["price"]) | bad_number(item["quantity"]), F.lit(BAD_NUMBER))


def purchase_items(parsed: DataFrame, profile: str = BATCH, keep: list[str] | None = None) -> DataFrame:
    """P3 (batch) / P5 (live): one row per purchased item.

    ``item_index_in_order`` is the 0-based position in the items array
    *before* dropping items without ``product_id``, so it can have gaps.
    An empty ``product_id`` is kept (only NULL is missing).
    """
    x = exploded_items(parsed, profile, keep)
    it = F.col("item")
    return x.where(_item_reason(profile, it, F.col("order_id")).isNull()).select(
        "order_id",
        F.col("item_pos").cast("long").alias("item_index_in_order"),
        "session_id",
        it["product_id"].alias("product_id"),
        it["product_name"].alias("product_name"),
        it["category"].alias("category"),
        to_double(it["price"]).alias("price"),
        to_bigint(it["quantity"]).alias("quantity"),
        F.col("ts").alias("purchase_event_timestamp"),
        *(keep or []),
    )


def rejects(parsed: DataFrame, profile: str = BATCH, with_payload: bool = True, keep: list[str] | None = None) -> DataFrame:
    """Every log-and-drop branch of the reference as a row.

    Columns: ``source, stage, reason, session_id, event_pos, item_pos,
    payload``. ``stage`` is ``record`` (whole record unusable), ``event``
    (an entry that is not an events row), ``purchase`` (a purchase whose
    items are all skipped) or ``item`` (one skipped item). Purchases in
    the live profile are not events rows but are not rejects either; only
    their failures are. In the batch profile every raw entry is either an
    events row or an ``event`` reject.

    One pass: each record is exploded once (``posexplode_outer`` keeps the
    rejected records and the empty ones as a single row), every row builds
    the array of its rejects (record, event, purchase, per-item), and that
    array is exploded. No union, so the input is decoded once.
    """
    _check_profile(profile)
    src = F.col("source") if "source" in parsed.columns else F.lit(None).cast("string")
    null_int = F.lit(None).cast("int")
    null_str = F.lit(None).cast("string")
    rec = F.col("rec")
    keep = keep or []
    rows = parsed.select(
        *keep, src.alias("source"), "reject_reason", "value",
        rec["session_id"].alias("session_id"),
        _first(rec, "first_event_pos").alias("_first"),
        rec["first_item_pos"].try_cast("long").alias("first_item"),
        F.posexplode_outer(F.when(F.col("reject_reason").isNull(), _events_array(rec))).alias("_pos", "entry"),
    )
    ev = F.col("entry.event")
    rows = rows.select(
        *keep, "source", "reject_reason", "value", "session_id", (F.col("_first") + F.col("_pos")).alias("event_pos"), "first_item", "entry",
        ev["event_type"].alias("event_type"),
        ev["timestamp"].alias("ts_text"),
        parse_iso_timestamp(ev["timestamp"]).alias("ts"),
        ev["details"].alias("details"),
    )

    def reject(stage: str, reason: Column, event_pos: Column, item_pos: Column, payload: Column) -> Column:
        return F.struct(
            F.lit(stage).alias("stage"), reason.alias("reason"), event_pos.cast("int").alias("event_pos"),
            item_pos.cast("int").alias("item_pos"), (payload if with_payload else null_str).alias("payload"),
        )

    is_record_row = F.col("reject_reason").isNotNull()
    has_entry = F.col("event_pos").isNotNull()
    is_purchase = has_entry & (F.col("event_type") == PURCHASE)
    # the entry itself is judged where it stands, not where its items go on
    is_own = F.col("first_item").isNull()

    ev_reason = _event_reason(profile)
    if profile == LIVE:
        # live purchases are checked by the purchase rules, not the event rules
        ev_reason = F.when(F.col("event_type") == PURCHASE, null_str).otherwise(ev_reason)
    pu_reason = _purchase_reason(profile)
    entry_json = F.to_json(F.col("entry"))

    record_part = F.when(
        is_record_row, F.array(reject("record", F.col("reject_reason"), null_int, null_int, F.col("value")))
    )
    event_part = F.when(
        has_entry & is_own & ev_reason.isNotNull(), F.array(reject("event", ev_reason, F.col("event_pos"), null_int, entry_json))
    )
    purchase_part = F.when(
        is_purchase & is_own & pu_reason.isNotNull(),
        F.array(reject("purchase", pu_reason, F.col("event_pos"), null_int, entry_json)),
    )
    items = F.coalesce(F.col("details.items"), F.array())
    item_part = F.when(
        is_purchase & pu_reason.isNull(),
        F.filter(
            F.transform(
                items,
                lambda it, j: reject("item", _item_reason(profile, it, F.col("details.order_id")), F.col("event_pos"), j + F.coalesce("first_item", F.lit(0)), F.to_json(it)),
            ),
            lambda r: r["reason"].isNotNull(),
        ),
    )
    empty = F.array().cast(
        "array<struct<stage:string,reason:string,event_pos:int,item_pos:int,payload:string>>"
    )
    all_rejects = F.concat(
        F.coalesce(record_part, empty), F.coalesce(event_part, empty),
        F.coalesce(purchase_part, empty), F.coalesce(item_part, empty),
    )
    out = rows.select(*keep, "source", "session_id", F.explode(all_rejects).alias("r"))
    return out.select(
        "source", F.col("r.stage").alias("stage"), F.col("r.reason").alias("reason"), "session_id",
        F.col("r.event_pos").alias("event_pos"), F.col("r.item_pos").alias("item_pos"),
        F.col("r.payload").alias("payload"), *keep,
    )


def tables(parsed: DataFrame, profile: str = BATCH, keep: list[str] | None = None) -> dict[str, DataFrame]:
    """What a load writes of parsed records, by table; visits as parts, which merge when they are read.

    ``keep`` names columns of the record that its rows carry in every table.
    """
    return {
        "visits": visit_parts(parsed, keep),
        "events": events(parsed, profile, keep),
        "purchase_items": purchase_items(parsed, profile, keep),
        "rejects": rejects(parsed, profile, keep=keep),
    }


def live_event_filter() -> Column:
    """F3 as a reusable predicate on an ``event_type`` column."""
    return F.col("event_type").isin(LIVE_EVENT_TYPES)


def session_present(c: Column) -> Column:
    """F1 as a reusable predicate."""
    return present(c)
