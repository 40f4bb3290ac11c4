"""Deduplication of a load against what is already there (R5/U1, incremental).

``quality.dedup`` shuffles all rows. A load is small and its history large, so
here the history is only searched for the load's keys:

1. Partitions of days that the load has no rows of are not read, where the day
   follows from the key. Of the others only the key columns are read.
2. A Bloom filter of the load's keys drops nearly all rows that cannot match in
   the scan's own stage. It is a table of 64-bit words: a key sets two bits of one
   word (``bit_or``, combined map-side), and history is joined with the words by
   their number. At 16 bits a key, 2 to 3 percent of other keys pass. The words are broadcast if
   their written size is within Spark's threshold; beyond that the filter would
   cost the shuffle that it saves, and is left out.
3. What passes is compared with the keys themselves in one aggregate, with a
   map-side step for hot keys; a false positive costs time and never a row.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.operators.quality import dedup
from clickweave.session import staged, written

BITS_A_KEY = 16
WORD_BITS = 64
#: What a word and its number take.
WORD_BYTES = 16


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, (left[k].eqNullSafe(right[k]) for k in keys))


def _word_and_mask(keys: Sequence[str], words: int) -> tuple[Column, Column]:
    """The number of a key's word and the two bits that it sets there (one bit if they fall together)."""
    h = F.xxhash64(*keys)
    bits = F.xxhash64(F.lit(1), *keys)
    first, second = (F.pmod(F.shiftright(bits, n), F.lit(WORD_BITS)).cast("int") for n in (0, 8))
    one = F.lit(1).cast("long")
    mask = F.call_function("shiftleft", one, first).bitwiseOR(F.call_function("shiftleft", one, second))
    return F.pmod(h, F.lit(words)), mask


def threshold_bytes(df: DataFrame) -> int:
    """Spark's bound of broadcast tables, in bytes (-1: never)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)) if text != "-1" else -1


def may_hold(history: DataFrame, load: DataFrame, keys: Sequence[str], bits_a_key: int = BITS_A_KEY) -> DataFrame:
    """Rows of ``history`` whose key may be in ``load``: all that are, and a few others.

    ``load`` should be a written table, as it is read twice. ``history`` comes
    back as it is where the filter would be too large to broadcast.
    """
    count = load.select(*keys).count()
    words = max(1, -(-count * bits_a_key // WORD_BITS))
    if words * WORD_BYTES > threshold_bytes(history):
        return history
    word, mask = _word_and_mask(keys, words)
    table = staged(load.groupBy(word.alias("_word")).agg(F.bit_or(mask).alias("_bits")), "key-filter")
    tested = history.withColumns({"_word": word, "_mask": mask}).join(table, "_word")
    return tested.where(F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).select(*history.columns)


def on_days(history: DataFrame, load: DataFrame, day: str, slack_days: int = 0) -> DataFrame:
    """Rows of ``history`` on the days of ``load``, NULL included, and up to ``slack_days`` off them."""
    days = [r[0] for r in load.select(day).distinct().collect()]  # a row a day
    near = sorted({d + _dt.timedelta(n) for d in days if d is not None for n in range(-slack_days, slack_days + 1)})
    wanted = F.col(day).isin(near) if near else F.lit(False)
    return history.where(wanted | F.col(day).isNull() if None in days else wanted)


def known_keys(load: DataFrame, history: DataFrame, keys: Sequence[str], day: str | None = None, slack_days: int = 0) -> DataFrame:
    """The keys of ``load`` that ``history`` has, each once.

    ``day`` names a column of both that follows from the key, up to
    ``slack_days``; without it all days are searched. A NULL in a key equals a
    NULL. ``load`` should be a written table.
    """
    keys = list(keys)
    if day:
        history = on_days(history, load, day, slack_days)
    # an aggregate, not a semi join: Catalyst moves that below the filter
    found = may_hold(history.select(*keys), load, keys).withColumn("_new", F.lit(False))
    sides = found.unionByName(load.select(*keys).withColumn("_new", F.lit(True))).groupBy(*keys)
    return sides.agg(F.bool_or("_new").alias("_new"), F.bool_and("_new").alias("_only")).where("_new and not _only").select(*keys)


def new_rows(load: DataFrame, history: DataFrame, keys: Sequence[str], day: str | None = None, slack_days: int = 0) -> DataFrame:
    """The rows of ``load`` that add a key to ``history``, one a key (the smallest row).

    ``history`` with these rows has the keys, and for each key found there before
    the row, that deduplicating everything would leave if earlier loads go first.
    A load or a history without rows gives no rows, or the load's own.
    """
    load = written(dedup(load, keys), "load")
    known = staged(known_keys(load, history, keys, day, slack_days), "known-keys")
    return load.join(known, _same(load, known, keys), "left_anti")
