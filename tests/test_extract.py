from pyspark.sql import functions as F

from clickweave.operators import extract
from clickweave.sources.decode import parse_sessions
from tests.conftest import ev, lines_df, session


def parsed(spark, rows):
    return parse_sessions(lines_df(spark, rows))


def test_visit_start_end_and_count(spark):
    rows = [
        session("A", [ev(timestamp="2024-07-01T10:00:00Z"), ev(timestamp="garbage"),
                      ev(timestamp="2024-07-01T12:00:00+02:00"), None, {}]),
        session("B"),
        session("C", []),
        session("D", None),
    ]
    v = {r.session_id: r for r in extract.visits(parsed(spark, rows)).collect()}
    assert v["A"].event_count == 5
    assert str(v["A"].start_timestamp) == "2024-07-01 10:00:00"
    assert str(v["A"].end_timestamp) == "2024-07-01 10:00:00"
    for k in "BCD":
        assert v[k].event_count == 0 and v[k].start_timestamp is None and v[k].end_timestamp is None


def test_timestamp_grammar(spark):
    bad = ["garbage", "2024", "now", "2024-7-1", " 2024-07-01T10:00:00 "]
    good = {"2024-07-01T10:00:00Z": "2024-07-01 10:00:00", "2024-07-01T10:00:00+02:00": "2024-07-01 08:00:00",
            "2024-07-01T10:00:00": "2024-07-01 10:00:00", "2024-07-01": "2024-07-01 00:00:00",
            "2024-07-01T10:00:00.123456": "2024-07-01 10:00:00.123456"}
    rows = [session("S", [ev(timestamp=t) for t in bad + list(good)])]
    p = parsed(spark, rows)
    evs = extract.events(p).orderBy("timestamp").collect()
    assert [str(r.timestamp) for r in evs] == sorted(good.values())
    rej = extract.rejects(p).where("stage = 'event'").collect()
    assert sorted(r.event_pos for r in rej) == [0, 1, 2, 3, 4]
    assert {r.reason for r in rej} == {"bad_timestamp"}


def test_profiles_event_types(spark):
    rows = [session("S", [ev("page_view"), ev("purchase", order_id="O1", items=[]), ev("error"),
                          ev(None), ev("promo_click", timestamp=None)])]
    p = parsed(spark, rows)
    batch = sorted(r.event_type for r in extract.events(p, "batch").collect())
    live = sorted(r.event_type for r in extract.events(p, "live").collect())
    assert batch == ["error", "page_view", "purchase"]
    assert live == ["page_view"]
    live_rej = sorted((r.event_pos, r.reason) for r in extract.rejects(p, "live").collect())
    assert live_rej == [(2, "unknown_event_type"), (3, "missing_type_or_timestamp"), (4, "missing_type_or_timestamp")]


def test_purchase_items_rules(spark):
    items = [{"product_id": "P1", "price": 10.0, "quantity": 2}, {"product_id": None, "price": 1},
             {"product_id": "", "price": "9.5", "quantity": 1.5}, {"product_id": "P4", "quantity": "20.0"}]
    rows = [session("S", [
        ev("purchase", order_id="O1", items=items),
        ev("purchase", order_id="", items=items),
        ev("purchase", timestamp=None, order_id="O3", items=items[:1]),
    ])]
    p = parsed(spark, rows)
    b = sorted((r.order_id, r.item_index_in_order, r.product_id, r.price, r.quantity,
                r.purchase_event_timestamp is None) for r in extract.purchase_items(p, "batch").collect())
    assert b == [("O1", 0, "P1", 10.0, 2, False), ("O1", 2, "", 9.5, None, False), ("O1", 3, "P4", None, 20, False),
                 ("O3", 0, "P1", 10.0, 2, True)]
    lv = sorted((r.order_id, r.item_index_in_order) for r in extract.purchase_items(p, "live").collect())
    assert lv == [("O1", 0), ("O1", 2), ("O1", 3)]
    rb = sorted((r.stage, r.reason, r.event_pos, r.item_pos) for r in extract.rejects(p, "batch").collect())
    assert rb == [("event", "missing_type_or_timestamp", 2, None), ("item", "missing_product_id", 0, 1),
                  ("purchase", "missing_order_id", 1, None)]
    rl = sorted((r.stage, r.reason, r.event_pos) for r in extract.rejects(p, "live").collect())
    assert rl == [("item", "missing_product_id", 0), ("purchase", "missing_order_id", 1),
                  ("purchase", "missing_type_or_timestamp", 2)]


def test_null_entries_and_details(spark):
    rows = [session("S", [None, {}, {"event": None}, {"event": {"event_type": "page_view",
                                                                 "timestamp": "2024-07-01", "details": None}}])]
    p = parsed(spark, rows)
    e = extract.events(p).collect()
    assert len(e) == 1 and e[0].page_url is None
    assert extract.visits(p).collect()[0].event_count == 4
    assert extract.rejects(p).where("stage='event'").count() == 3


def test_event_ids_deterministic_and_distinct(spark):
    rows = [session("S", [ev(), ev(), ev("add_item_to_cart", product_id="P", price=1.0, quantity=1)])]
    a = [r.event_unique_id for r in extract.events(parsed(spark, rows)).orderBy("event_unique_id").collect()]
    b = [r.event_unique_id for r in extract.events(parsed(spark, rows)).orderBy("event_unique_id").collect()]
    assert a == b and len(set(a)) == 3


def test_batch_invariant_event_count(spark):
    rows = [session("S", [ev(), ev(timestamp="bad"), None, ev("purchase", order_id=None)]),
            session("T", [ev("error")]), "not json"]
    p = parsed(spark, rows)
    total = extract.visits(p).agg(F.sum("event_count")).first()[0]
    n_events = extract.events(p).count()
    n_rej = extract.rejects(p).where("stage = 'event'").count()
    assert total == n_events + n_rej
    assert extract.rejects(p).where("stage = 'record'").count() == 1


def test_no_shuffle_in_extraction(spark):
    p = parsed(spark, [session("S", [ev()])])
    # visits: only rows that say they are parts of a session are shuffled
    for df in (extract.visit_parts(p), extract.events(p), extract.purchase_items(p)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
