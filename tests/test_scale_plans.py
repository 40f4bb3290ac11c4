"""Plan-shape checks for the scale properties the README claims."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickweave.operators import extract, orders, reports
from clickweave.plans.batch import run_batch
from clickweave.sources.decode import parse_sessions
from clickweave.sources.derived import session_records
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_change_no_table(spark):
    """Sessions and orders cut into many records give the tables of whole ones."""
    frames = []
    for bounds in ({}, {"max_events_per_record": 2, "max_items_per_record": 3}):
        rec = session_records(spark, SF_SMALL, **bounds)
        frames.append((rec, parse_sessions(rec.select("value", F.col("message_id").alias("source")))))
    (whole, pw), (cut, pc) = frames
    assert cut.count() > whole.count()
    assert pc.agg(F.max(F.size("rec.events"))).first()[0] == 2
    assert pc.select(F.explode("rec.events").alias("e")).agg(F.max(F.size("e.event.details.items"))).first()[0] == 3
    made = {
        "visits": extract.visits, "events": extract.events, "live": lambda p: extract.events(p, "live"),
        "items": extract.purchase_items, "live items": lambda p: extract.purchase_items(p, "live"),
        "rejects": lambda p: extract.rejects(p, "live", with_payload=False).drop("source"),
        "cart": orders.cart_before_purchase, "devices": lambda p: reports.visits_by_device(extract.visits(p)),
        "orders": lambda p: orders.order_reconciliation(extract.events(p), extract.purchase_items(p)),
    }
    for name, f in made.items():
        a, b = f(pw), f(pc)
        assert a.count() == b.count() > 0, name
        assert a.exceptAll(b).count() == 0, name
    assert extract.events(pc).select("event_unique_id").distinct().count() == extract.events(pc).count()
    assert cut.select("publish_time").distinct().exceptAll(whole.select("publish_time").distinct()).count() == 0


def test_report_aggregates_combine_map_side(spark):
    p = parse_sessions(session_records(spark, SF_SMALL).select("value", F.col("message_id").alias("source")))
    ev = extract.events(p)
    for df in (reports.visits_by_page(ev), reports.visits_by_device(extract.visits(p)),
               reports.sales_by_category(extract.purchase_items(p))):
        plan = _plan(df)
        assert "partial_" in plan, plan


def test_curated_reads_prune_partitions_and_columns(spark, tmp_path):
    import os

    lines = session_records(spark, SF_SMALL).select("value").collect()
    d = tmp_path / "in"
    d.mkdir()
    with open(os.path.join(d, "s.jsonl"), "w") as f:
        for r in lines:
            f.write(r.value + "\n")
    run_batch(spark, str(d), database="prune_t")
    q = spark.table("prune_t.events").where(F.col("event_date") == F.lit("2024-01-02").cast("date")).select("page_url")
    plan = _plan(q)
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<page_url:string,origin:string>" in plan  # origin: which load a row is of
    assert q.count() > 0


def test_one_session_with_a_third_of_all_events(spark, tmp_path):
    """A hot key holding a third of all rows is split into bounded records, nothing lost."""
    import shutil

    src = SF_SMALL
    d = tmp_path / "hot"
    d.mkdir()
    for t in ("lineitem", "part"):
        shutil.copy(f"{src}/{t}.parquet", d / f"{t}.parquet")
    ev = spark.read.parquet(f"{src}/events.parquet")
    hot = F.col("event_id") % 3 == 0
    ev = ev.select(
        "event_id",
        F.when(hot, F.to_timestamp_ntz(F.lit("2024-01-05 00:00:00")) + F.make_dt_interval(secs=F.col("event_id")))
        .otherwise(F.col("ts")).alias("ts"),
        F.when(hot, F.lit(7).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type", "value", "props",
    )
    ev.coalesce(1).write.parquet(str(d / "events_dir"))
    part_file = [p for p in (d / "events_dir").iterdir() if p.name.endswith(".parquet")][0]
    shutil.copy(part_file, d / "events.parquet")
    n_events = ev.count()
    n_hot = ev.where(hot).count()
    assert n_hot * 3 >= n_events - 3

    bound = 50
    rec = session_records(spark, str(d), max_events_per_record=bound)
    p = parse_sessions(rec.select("value", F.col("message_id").alias("source")))
    v = extract.visit_parts(p)
    hot_sid = "SID-7-20240105"
    hot_parts = v.where(F.col("session_id") == hot_sid)
    assert hot_parts.count() >= n_hot // bound
    # every record of the hot session stays within the bound
    assert hot_parts.agg(F.max("event_count")).first()[0] <= bound
    assert extract.visits(p).where(F.col("session_id") == hot_sid).count() == 1
    # nothing lost: all events are in some record, and the consolidated visit has them all
    assert v.agg(F.sum("event_count")).first()[0] == n_events
    from clickweave.operators import quality

    merged = quality.consolidate_visits(v).where(F.col("session_id") == hot_sid).first()
    assert merged.event_count == hot_parts.agg(F.sum("event_count")).first()[0] >= n_hot


def test_shared_folder_is_required_off_local_masters():
    from clickweave.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Fake())


def test_a_side_of_many_rows_is_not_broadcast(spark, monkeypatch):
    """files of keys are small, what they take on the driver is not; rows stay the same."""
    from clickweave.operators import skew

    rows = spark.range(3000).select((F.col("id") % 900).alias("k"), F.col("id").alias("v"))
    seen = []
    for most in (skew.MOST_BROADCAST_ROWS, 100):
        monkeypatch.setattr(skew.many, "__defaults__", (most,))
        cut = skew.split_hot_groups(rows, ["k"], 2, ["v"])
        out = Counter(tuple(r) for r in cut.collect())
        seen.append((out, "BroadcastHashJoin" in cut._jdf.queryExecution().executedPlan().toString()))
    assert seen[0][0] == seen[1][0] and sum(seen[0][0].values()) == 3000
    assert seen[0][1] and not seen[1][1]


def test_rows_of_a_load_are_not_shuffled_by_attempt(spark):
    """Views join rows with the few commits; a shuffle by attempt would send a whole load to one task."""
    from clickweave.sinks import tables as sinks

    for load in ("a", "b"):
        sinks.land_raw(spark.range(50).select(F.col("id").cast("string").alias("value")), "shown_t", load)
    view = spark.table("shown_t.sessions_raw")
    plan = _plan(view)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3, plan
    assert view.groupBy("load_id").count().count() == 2 and view.count() == 100


def _base_tables(spark, root):
    """Two users' events of a day, one order of 4 items, one product twice in the catalogue's numbering."""
    import datetime as dt

    from clickweave.sources.derived import BASE_SCHEMAS

    day = dt.datetime(2024, 1, 1, 10)
    kinds = ["view", "purchase", "click", "view", "signup"]
    events = [(i, day + dt.timedelta(minutes=i), 1, kinds[i], 0.0, "") for i in range(5)] + [(7, day, 2, "purchase", 0.0, "")]
    items = [(o, 1 + n % 2, 1, n, 2.0, 1.0, 0.0, 0.0, "N", "O", day) for o in (1, 7) for n in range(4)]
    parts = [(1, "one", "B", "T1", 1, 10.0), (2, "two", "B", "T2", 1, 20.0)]
    for name, rows in (("events", events), ("lineitem", items), ("part", parts)):
        spark.createDataFrame(rows, BASE_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_cut_sessions_build_an_entry_once(spark, tmp_path):
    """F8: sessions are cut as narrow rows of the base table, so the catalogue is looked up and entries are shuffled once."""
    import json

    from clickweave.sources.derived import build_session_records

    records = build_session_records(spark, _base_tables(spark, tmp_path), 2, 3)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 1, plan
    got = {r.message_id: (r.publish_time.strftime("%H:%M"), json.loads(r.value)) for r in records.collect()}
    long = "SID-1-20240101"
    assert {k: (t, v.get("part"), v.get("parts"), v.get("first_event_pos"), v.get("first_item_pos")) for k, (t, v) in got.items()} == {
        f"{long}#0": ("10:04", 0, 3, 0, None), f"{long}#1": ("10:04", 1, 3, 2, None), f"{long}#2": ("10:04", 2, 3, 4, None),
        f"{long}#ORD-1#1": ("10:04", None, None, 1, 3),
        "SID-2-20240101#0": ("10:00", None, None, None, None), "SID-2-20240101#ORD-7#1": ("10:00", None, None, 0, 3),
    }
    assert [[e["event"]["event_type"] for e in got[f"{long}#{i}"][1]["events"]] for i in range(3)] == [["page_view", "purchase"], ["add_item_to_cart", "page_view"], ["promo_click"]]


def test_dashboard_filters_and_decodes_messages_once(spark, tmp_path, monkeypatch):
    """F8: the four reports read the records of one stream; each used to filter and decode all messages."""
    from clickweave.plans import queries
    from clickweave.streaming import ingest

    calls = Counter()
    for module, name in ((ingest, "without_replays"), (queries, "parse_messages"), (ingest, "start_updates"), (ingest, "compact_updates"), (ingest, "read_dashboard")):
        monkeypatch.setattr(module, name, lambda *a, f=getattr(module, name), n=name, **k: calls.update([n]) or f(*a, **k))
    got = {(r.report, r.group_key): r.value for r in queries.QUERIES["live_dashboard_stream"](spark, _base_tables(spark, tmp_path)).collect()}
    assert calls == {"without_replays": 1, "parse_messages": 1, "start_updates": 4, "compact_updates": 4, "read_dashboard": 4}
    assert got == {
        ("visits_by_device", "desktop"): 1.0, ("visits_by_device", "tablet"): 1.0,
        ("product_totals", "P-1"): 8.0, ("product_totals", "P-2"): 8.0,
        ("sales_by_category", "T1"): 80.0, ("sales_by_category", "T2"): 160.0,
        ("visits_by_page", "https://example.com/p/0"): 1.0, ("visits_by_page", "https://example.com/p/3"): 1.0,
    }
