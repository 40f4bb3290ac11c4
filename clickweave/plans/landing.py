"""Landed tables: what the batch and the live job write, once per input.

Reports run on landed tables, as they do in production, not on records they
decode again. The first query of an input that needs a table writes it to the
shared folder (``session.staged``); later ones read its columns. Inputs are
known by their files, so a changed input is landed anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickweave.operators import extract
from clickweave.session import COMPACT, staged
from clickweave.sources.decode import parse_messages, parse_sessions
from clickweave.sources.derived import session_messages, session_records


def parsed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session records decoded as JSONL lines (batch path, S1/S2)."""
    rec = session_records(spark, sf_dir)
    return parse_sessions(rec.select("value", rec["message_id"].alias("source"), "publish_time"))


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session records decoded as messages (stream path, S5/S6)."""
    return parse_messages(session_messages(spark, sf_dir))


TABLES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parsed": parsed_sessions,
    "live_parsed": parsed_messages,
    "visits": lambda s, d: extract.visits(landed(s, d, "parsed")),
    "events": lambda s, d: extract.events(landed(s, d, "parsed"), extract.BATCH),
    "purchase_items": lambda s, d: extract.purchase_items(landed(s, d, "parsed"), extract.BATCH),
    "live_visits": lambda s, d: extract.visits(landed(s, d, "live_parsed")),
    "live_events": lambda s, d: extract.events(landed(s, d, "live_parsed"), extract.LIVE),
}

_LANDED: dict[tuple, DataFrame] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The landed table ``name`` of an input."""
    # the written records are one object per input and bounds
    key = (id(session_records(spark, sf_dir)), name)
    if key not in _LANDED:
        _LANDED[key] = staged(TABLES[name](spark, sf_dir), f"landed-{name}", **COMPACT)
    return _LANDED[key]


def land(spark: SparkSession, sf_dir: str) -> None:
    """Writes all tables of an input."""
    for name in TABLES:
        landed(spark, sf_dir, name)
