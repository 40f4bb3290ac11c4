"""Broadcasts of narrow tables whose size is checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a broadcast table of ids, two columns of eight bytes at most (about 64 MB in memory).
MOST_IDS = 500_000


def few(ids: DataFrame, most: int = MOST_IDS) -> bool:
    """Whether the written table ``ids`` is within the bound, in rows and in width."""
    narrow = len(ids.columns) <= 2 and all(isinstance(f.dataType, T.IntegralType) for f in ids.schema.fields)
    return narrow and ids.count() <= most


def small_ids(ids: DataFrame) -> DataFrame:
    """``ids``, a written table, marked for broadcast if it is within the bound.

    A join with it then leaves the other side, whole texts, where it is.
    Beyond the bound the table stays as it is, and the join shuffles both
    sides.
    """
    return F.broadcast(ids) if few(ids) else ids


def only(rows: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Rows of ``ids`` alone where a broadcast can tell them; else all rows, for the join that follows."""
    return rows.join(F.broadcast(ids), on, "left_semi") if few(ids) else rows
