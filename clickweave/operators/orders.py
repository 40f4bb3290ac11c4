"""Orders and event ordering.

``sort_session_events`` works inside one record with higher-order array
functions (no shuffle); ``cart_before_purchase`` runs over the cart adds and
purchases of each record, and carries totals between the parts of a long
session. ``order_amounts`` aggregates by order with a map-side partial sum;
``assemble_sessions`` goes the other way, from flat events to nested records,
and cuts long sessions into contiguous parts with ``split_hot_groups`` so no
gathered array is unbounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.scalars import is_missing, iso_text, money_exact, money_of, money_rest, money_sum, to_bigint, to_double
from clickweave.operators.extract import PURCHASE, _good, exploded_events
from clickweave.operators.skew import split_hot_groups
from clickweave.session import staged

CART_ADD = "add_item_to_cart"


def order_amounts(items: DataFrame) -> DataFrame:
    """``round(sum(price * quantity), 2)`` per order, NULL counted as 0."""
    return items.groupBy("order_id").agg(
        money_sum(F.col("price"), F.col("quantity")).alias("item_total"),
        F.count(F.lit(1)).alias("item_rows"),
    )


def order_reconciliation(events: DataFrame, items: DataFrame) -> DataFrame:
    """Stated purchase ``amount`` against the item total of the order.

    One row per purchase event that has an order id. ``difference`` is
    ``amount - item_total`` (item_total 0 when the order has no items);
    ``matches`` allows a half-cent of float noise. The totals are written
    first, so that both sides of the join are shuffled from files and AQE can
    split an order that many purchase events name.
    """
    purchases = events.where((F.col("event_type") == PURCHASE) & ~is_missing(F.col("order_id"))).select(
        "order_id", "session_id", F.col("amount").alias("stated_amount")
    )
    totals = staged(order_amounts(items), "order-totals")
    j = purchases.join(totals, "order_id", "left")
    total = F.coalesce(F.col("item_total"), F.lit(0.0))
    diff = F.round(F.coalesce(F.col("stated_amount"), F.lit(0.0)) - total, 2)
    return j.select(
        "order_id", "session_id", "stated_amount",
        total.alias("item_total"),
        F.coalesce(F.col("item_rows"), F.lit(0)).cast("long").alias("item_rows"),
        diff.alias("difference"),
        (F.abs(diff) < 0.005).alias("matches"),
    )


def cart_before_purchase(parsed: DataFrame) -> DataFrame:
    """R2: for each purchase, the cart adds earlier in the same session.

    The generator's rule is that a purchase buys every item added to the
    cart before it (the cart is never cleared). Per purchase event this
    returns the number of earlier cart adds, their total quantity and
    value: running sums over the cart adds and purchases of a record, which
    has a bounded number of events, plus the totals of the earlier parts if
    the record is a part of a long session.
    """
    marked = parsed.withColumn("_record", F.monotonically_increasing_id())
    part = F.col("rec.part").try_cast("long")
    x = exploded_events(marked.withColumn("_part", part), keep=["_record", "_part"]).where(F.col("first_item").isNull())
    is_cart = F.col("event_type") == CART_ADD
    is_order = (F.col("event_type") == PURCHASE) & ~is_missing(F.col("details.order_id"))
    price, quantity = to_double(F.col("details.price")), to_bigint(F.col("details.quantity"))
    x = x.where(is_cart | is_order).select(
        "_record", "_part", "session_id", "event_pos", is_order.alias("is_order"), F.col("details.order_id").alias("order_id"),
        is_cart.cast("long").alias("adds"),
        F.when(is_cart, quantity).cast("decimal(38,0)").alias("quantity"),
        F.when(is_cart, money_exact(price, quantity)).alias("exact"),
        F.when(is_cart, money_rest(price, quantity)).alias("rest"),
    )
    sums = ("adds", "quantity", "exact", "rest")

    def total(c: str):
        return F.try_sum(c) if c == "exact" else F.sum(c)

    earlier = Window.partitionBy("_record").orderBy("event_pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = x.withColumns({f"own_{c}": total(c).over(earlier) for c in sums}).where("is_order")
    # parts: a copy of a part counts once
    parts = x.where(F.col("_part").isNotNull()).groupBy("_record", "session_id", "_part").agg(*(total(c).alias(c) for c in sums))
    parts = parts.groupBy("session_id", "_part").agg(*(F.min(c).alias(c) for c in sums))
    carry = Window.partitionBy("session_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("session_id", "_part", *(total(c).over(carry).alias(f"carry_{c}") for c in sums))
    rows = rows.join(parts, ["session_id", "_part"], "left")

    def both(c: str):
        own, before = F.col(f"own_{c}"), F.col(f"carry_{c}")
        return F.coalesce(own + before, own, before)

    return rows.select(
        "session_id",
        "order_id",
        F.col("event_pos").cast("long").alias("purchase_pos"),
        F.coalesce(both("adds"), F.lit(0)).cast("long").alias("cart_adds"),
        F.coalesce(both("quantity"), F.lit(0)).try_cast("bigint").alias("cart_quantity"),
        money_of(both("exact"), both("rest")).alias("cart_value"),
    )


def sort_session_events(parsed: DataFrame) -> DataFrame:
    """O2: the record with its events ordered by timestamp text, stably.

    ``array_sort`` on ``(timestamp, original position, entry)`` keeps equal
    timestamps in input order, like Python's stable sort.
    """
    rec = F.col("rec")
    evs = F.coalesce(rec["events"], F.array())
    keyed = F.transform(evs, lambda e, i: F.struct(e["event"]["timestamp"].alias("k"), i.alias("i"), e.alias("e")))
    ordered = F.transform(F.array_sort(keyed), lambda s: s["e"])
    return _good(parsed).select(F.col("rec").withField("events", ordered).alias("rec"), "reject_reason", *[
        c for c in parsed.columns if c not in ("rec", "reject_reason")
    ])


def assemble_sessions(flat_events: DataFrame, max_events_per_record: int = 10_000) -> DataFrame:
    """Flat ``events`` rows back into nested session records (JSON text).

    Events are ordered by ``(timestamp, event_unique_id)``. Sessions above
    ``max_events_per_record`` become several records, contiguous parts that
    say their place, so no gathered array is unbounded and the records decode
    to the same visits and events as one record would.
    """
    detail_cols = [
        "page_url", "referrer_url", "product_id", "product_name", "category",
        "price", "quantity", "order_id", "amount", "currency",
    ]
    entry = F.struct(
        F.struct(
            F.col("event_type").alias("event_type"),
            iso_text(F.col("timestamp")).alias("timestamp"),
            F.struct(*[F.col(c) for c in detail_cols]).alias("details"),
        ).alias("event")
    )
    df = flat_events.select(
        "session_id", "user_id", "device_type", "timestamp", "event_unique_id", entry.alias("entry")
    )
    df = split_hot_groups(
        df, ["session_id"], max_events_per_record, ["timestamp", "event_unique_id"],
        sizes_from=flat_events.select("session_id"),
    )
    grouped = df.groupBy("session_id", "part", "parts").agg(
        F.array_sort(F.collect_list(F.struct("timestamp", "event_unique_id", "entry"))).alias("_sorted"),
        F.min("user_id").alias("user_id"),
        F.min("device_type").alias("device_type"),
    )
    record = F.struct(
        "session_id", "user_id", "device_type", "part", "parts",
        (F.col("part") * max_events_per_record).alias("first_event_pos"),
        F.transform("_sorted", lambda x: x["entry"]).alias("events"),
    )
    return grouped.select(
        "session_id", F.coalesce("part", F.lit(0)).alias("part"), F.to_json(record).alias("value")
    )
