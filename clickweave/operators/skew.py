"""Skew guards shared by the operators.

Rows that must be gathered into one nested value per key (a session's events,
an order's items) are never gathered beyond a bound: the keys with more rows
are cut into contiguous ranges of their order, so position = start of the
range + position in it, and what is made of the ranges equals what the whole
would give. ``numbered`` finds positions without putting a key into one task;
keys of at most ``MOST_WINDOW_ROWS`` rows are placed by a window.

Sides of joins are not marked for broadcast here: a small table is written
(``session.staged``) and Catalyst decides by its real size. That size is of
compressed files, a small part of what a broadcast of keys takes on the driver,
so a side of many rows is kept from it (``many``): both sides are shuffled from
files, which AQE can split by skew.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import staged


#: Rows up to which a side of a join may be broadcast (about 16 MB of keys in memory).
MOST_BROADCAST_ROWS = 100_000
#: Rows of a key up to which one task may place them.
MOST_WINDOW_ROWS = 10_000


def many(side: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """A written or base table as the side of a join, never broadcast if it has more than ``most`` rows."""
    return side.hint("merge") if side.count() > most else side


def hot_keys(sizes_from: DataFrame, keys: Sequence[str], max_rows: int, of_key: dict[str, Column] | None = None) -> DataFrame:
    """Written table of the keys with more than ``max_rows`` rows, their ``_rows`` and the aggregates ``of_key``.

    Sizes are counted with a partial (map-side) aggregate, so counting a hot
    key is cheap; at most ``total_rows / max_rows`` keys qualify.
    """
    sizes = sizes_from.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *(v.alias(c) for c, v in (of_key or {}).items()))
    return staged(sizes.where(F.col("_rows") > max_rows), "hot-keys")


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``_pos``: the 0-based place of each row in the order of its key.

    Rows are range-partitioned by key and order and written; places are
    counted within (key, range) and the sizes of a key's earlier ranges added,
    so neither a window nor a task holds a whole key.
    """
    keys = list(keys)
    ranged = df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = staged(ranged, "ranges")
    sizes = staged(ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n")), "range-sizes")
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    sizes = many(sizes).withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order)) - 1
    return ranged.withColumn("_own", own).join(sizes, [*keys, "_range"]).withColumn("_pos", F.col("_own") + F.col("_before")).drop("_own", "_before", "_range")


def split_hot_groups(
    df: DataFrame, keys: Sequence[str], max_rows: int, order: Sequence[str], sizes_from: DataFrame | None = None, part_col: str = "part",
    pos_col: str | None = None, of_key: dict[str, Column] | None = None,
) -> DataFrame:
    """Adds ``part_col`` and ``parts``: which contiguous range of how many a row's key is cut into.

    Both are NULL for rows of keys with at most ``max_rows`` rows, which is
    one group as before. Keys must not be NULL. Likewise ``pos_col``, the
    0-based place of a row in its key, and the aggregates ``of_key`` of the
    key's rows in ``sizes_from``, for the rows of keys that are cut.

    Keys that a window can place meet their sizes in one shuffle, which the
    rows of keys that are not cut share; only longer ones are ``numbered``.
    """
    keys, of_key = list(keys), of_key or {}
    hot = hot_keys(sizes_from if sizes_from is not None else df, keys, max_rows, of_key)
    none = {c: F.lit(None).cast("long") for c in (part_col, "parts", *([pos_col] if pos_col else []))}
    none |= {c: F.lit(None).cast(hot.schema[c].dataType) for c in of_key}
    if hot.isEmpty():
        return df.withColumns(none)
    hot, long = many(hot), hot.where(F.col("_rows") > MOST_WINDOW_ROWS)
    cut = []
    if max_rows < MOST_WINDOW_ROWS:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long") - 1
        cut.append(df.join(hot.where(F.col("_rows") <= MOST_WINDOW_ROWS), keys).withColumn("_pos", place))
    if not long.isEmpty():
        long = many(long)
        cut.append(numbered(df.join(long.select(*keys), keys, "left_semi"), keys, order).join(long, keys))
    cold = df.join(hot, keys, "left_anti").withColumns(none)
    cut = reduce(DataFrame.unionByName, cut)
    cut = cut.withColumns({part_col: F.floor(F.col("_pos") / max_rows), "parts": F.ceil(F.col("_rows") / max_rows)}).drop("_rows")
    cut = cut.withColumnRenamed("_pos", pos_col) if pos_col else cut.drop("_pos")
    return cold.unionByName(cut)
