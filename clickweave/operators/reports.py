"""Dashboard reports and table relations.

Aggregates shuffle only their grouping key and always with a map-side
partial aggregate, so a hot key (one page, one device type, one product)
is combined inside each input task before the shuffle. Distinct counts
are planned by Spark as a two-level aggregate on ``(key, value)`` first,
which spreads a hot key over many tasks.

Joins with visits: a side that is made one row per session is an aggregate, and
a join right above it would reuse its shuffle, which AQE cannot split. Such a
side is written before (``session.staged``; visits once, when they are loaded);
then both sides of the join are read from files, and AQE splits a session that
holds many rows (or broadcasts the written side by its real size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.scalars import money_sum, whole_sum
from clickweave.session import staged, written


def visits_by_page(events: DataFrame) -> DataFrame:
    """A4: distinct sessions per ``page_url`` over page_view events."""
    return (
        events.where(F.col("event_type") == "page_view")
        .groupBy("page_url")
        .agg(F.count_distinct("session_id").alias("visits"))
    )


def popular_items(items: DataFrame, k: int = 10) -> DataFrame:
    """A5/O3: top-k products by total quantity; ties by product_id.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task
    keeps its own top k and only k rows per task reach the final merge.
    """
    totals = items.groupBy("product_id").agg(
        whole_sum(F.col("quantity")).alias("total_quantity"),
        F.count(F.lit(1)).alias("order_lines"),
    )
    return totals.orderBy(F.col("total_quantity").desc(), F.col("product_id").asc()).limit(k)


def sales_by_category(items: DataFrame) -> DataFrame:
    """Sum of price * quantity per category, rounded once (exact DECIMAL sum, DOUBLE out)."""
    return items.groupBy("category").agg(
        money_sum(F.col("price"), F.col("quantity")).alias("sales"),
        F.count(F.lit(1)).alias("item_rows"),
    )


def visits_by_device(visits: DataFrame) -> DataFrame:
    """Visits per device type."""
    return visits.groupBy("device_type").agg(F.count(F.lit(1)).alias("visits"))


def events_with_visit(events: DataFrame, visits: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Events left-joined with their visit (ER relation events -> visits).

    A join on ``session_id`` with the columns that the events table does not
    already carry. ``visits`` has one row per session (of several paths or
    loads, by ``quality.consolidate_visits``) and is written unless it is a table.
    ``keys`` are those of tables that are laid out by more than the session.
    """
    v = written(visits, "visits").select(
        *keys,
        F.col("start_timestamp").alias("visit_start"),
        F.col("end_timestamp").alias("visit_end"),
        F.col("event_count").alias("visit_event_count"),
        "geolocation",
    )
    return events.join(v, list(keys), "left")


def items_with_visit(items: DataFrame, visits: DataFrame, keys: Sequence[str] = ("session_id",)) -> DataFrame:
    """Purchase items left-joined with their visit (``visits`` and ``keys`` as in J1)."""
    v = written(visits, "visits").select(
        *keys, "user_id", "device_type", F.col("start_timestamp").alias("visit_start")
    )
    return items.join(v, list(keys), "left")


def orphans(child: DataFrame, visits: DataFrame) -> DataFrame:
    """Child rows whose session has no visit (left anti join).

    The key side is made distinct first (partial aggregate), so a session
    with many visit copies reaches the join as one key.
    """
    return child.join(staged(visits.select("session_id").distinct(), "visit-keys"), "session_id", "left_anti")


def sessions_with_purchase(visits: DataFrame, items: DataFrame) -> DataFrame:
    """Visits that have at least one purchased item (left semi join).

    The item side is reduced to distinct session ids map-side, so a session
    holding a large share of all items is one key at the join.
    """
    return visits.join(staged(items.select("session_id").distinct(), "item-keys"), "session_id", "left_semi")
