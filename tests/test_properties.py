"""Invariants over random sessions with random defects (SURVEY §5 (c))."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickweave.operators import extract
from clickweave.sources.decode import parse_sessions

TS = st.sampled_from(["2024-07-01T10:00:00Z", "2024-07-01T10:00:00", "2024-07-01", "garbage", "2024", "", None,
                      "2024-07-01T12:30:00+02:00"])
TYPES = st.sampled_from(["page_view", "add_item_to_cart", "purchase", "promo_view", "error", "", None])
ITEM = st.fixed_dictionaries({}, optional={
    "product_id": st.sampled_from(["P1", "", None]),
    "price": st.sampled_from([1.5, "9.5", "x", None, 3]),
    "quantity": st.sampled_from([1, 2.0, 1.5, "3", None]),
})
DETAILS = st.fixed_dictionaries({}, optional={
    "page_url": st.sampled_from(["/a", "/b", None]),
    "order_id": st.sampled_from(["O1", "O2", "", None]),
    "items": st.lists(ITEM, max_size=3),
    "price": st.sampled_from([1.0, "2", None]),
})
EVENT = st.fixed_dictionaries({}, optional={"event_type": TYPES, "timestamp": TS, "details": st.one_of(st.none(), DETAILS)})
ENTRY = st.one_of(st.none(), st.just({}), st.builds(lambda e: {"event": e}, st.one_of(st.none(), EVENT)))
SESSION = st.fixed_dictionaries({}, optional={
    "session_id": st.sampled_from(["S1", "S2", "S3", "", None]),
    "device_type": st.sampled_from(["mobile", None]),
    "events": st.one_of(st.none(), st.lists(ENTRY, max_size=5)),
})
LINE = st.one_of(SESSION.map(json.dumps), st.sampled_from(["", "not json", "[1]", '{"events": "x"}']))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(lines=st.lists(LINE, min_size=1, max_size=8))
def test_invariants(spark, lines):
    df = spark.createDataFrame([(x, f"l{i}") for i, x in enumerate(lines)], "value string, source string")
    p = parse_sessions(df).cache()
    visits = extract.visits(p)
    rej_b = extract.rejects(p, "batch", with_payload=False).cache()
    # every input line is exactly one visit or one record-level reject
    assert visits.count() + rej_b.where("stage = 'record'").count() == len(lines)
    # batch: every raw entry is an events row or an event reject
    total = visits.agg(F.coalesce(F.sum("event_count"), F.lit(0))).first()[0]
    ev_b = extract.events(p, "batch")
    assert total == ev_b.count() + rej_b.where("stage = 'event'").count()
    # live rows are a subset of batch rows
    ev_l = extract.events(p, "live")
    assert ev_l.select("event_unique_id").exceptAll(ev_b.select("event_unique_id")).count() == 0
    it_b = extract.purchase_items(p, "batch")
    it_l = extract.purchase_items(p, "live")
    key = ["session_id", "order_id", "item_index_in_order"]
    assert it_l.select(*key).exceptAll(it_b.select(*key)).count() == 0
    # batch items: every item of a purchase with an order id is a row or an item reject
    items_seen = extract.exploded_items(p, "batch").count()
    assert items_seen == it_b.count() + rej_b.where("stage = 'item'").count()
    # required output columns are never NULL
    assert ev_b.where("session_id IS NULL OR event_unique_id IS NULL OR event_type IS NULL OR timestamp IS NULL").count() == 0
    assert it_b.where("order_id IS NULL OR product_id IS NULL OR session_id IS NULL").count() == 0
    p.unpersist()
    rej_b.unpersist()


def test_iso_timestamps_as_python_reads_them(spark):
    """Every text of the grammar gives what ``datetime.fromisoformat`` gives (offset-less: UTC)."""
    import datetime as dt
    import random

    from clickweave.functions.scalars import parse_iso_timestamp

    rng = random.Random(3)
    dates = ["2024-07-01", "20240701", "2024-W27", "2024W27", "2024-W27-3", "2024W273", "2020-W53-7", "2021-W53-1", "2024-W00-1", "2024-02-30", "2024-13-01", "2024-W27-8", "2024-W27-0", "0001-01-01"]
    times = ["", "10", "10:05", "1005", "10:05:07", "100507", "10:05:07.5", "100507,25", "10:05:07.123456", "10:05:07,1234567", "24:00", "10:60", "10:05:61", "1005:07", "10:0507"]
    offsets = ["", "Z", "+02", "-02:30", "+0230", "+02:30:15", "-023015", "+02:30:15.5", "+23:59", "+24:00", "-00:00"]
    texts = ["", "now", "2024", "2024-7-1", " 2024-07-01", "2024-07-01 ", "2024-07-01T", "2024-07-01T1", "2024-07-01T10:00:00+2", "2024-07", "2024-07-01T10Z0"]
    for d in dates:
        for t in times:
            texts += [d + rng.choice("T _x") + t + rng.choice(offsets) for _ in range(3)] if t else [d]
    want = {}
    for text in texts:
        try:
            at = dt.datetime.fromisoformat(text)
            at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
            want[text] = (at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        except (ValueError, OverflowError):
            want[text] = None
    df = spark.createDataFrame([(t,) for t in want], "t string")
    got = {r.t: r.at for r in df.select("t", F.unix_micros(parse_iso_timestamp("t")).alias("at")).collect()}
    differ = {t: (got[t], want[t]) for t in want if got[t] != want[t] and not ("24:00" in t and got[t] is None)}
    assert not differ, differ
