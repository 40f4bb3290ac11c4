from pyspark.sql import functions as F

from clickweave.operators import orders, quality, reports, skew
from clickweave.operators import extract
from clickweave.sources.decode import parse_sessions
from tests.conftest import ev, lines_df, session


def parsed(spark, rows):
    return parse_sessions(lines_df(spark, rows))


def items_df(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, product_id string, category string, price double, quantity long, session_id string"
    )


def test_popular_items_ties_by_product(spark):
    df = items_df(spark, [("O1", "B", "c", 1.0, 5, "s"), ("O2", "A", "c", 1.0, 5, "s"), ("O3", "C", "c", 1.0, 9, "s"),
                          ("O4", "D", "c", 1.0, None, "s")])
    got = [(r.product_id, r.total_quantity) for r in reports.popular_items(df, k=3).collect()]
    assert got == [("C", 9), ("A", 5), ("B", 5)]


def test_sales_by_category_exact(spark):
    df = items_df(spark, [("O", "A", "x", 0.1, 3, "s"), ("O", "B", "x", 0.2, 1, "s"), ("O", "C", "y", None, 2, "s")])
    got = {r.category: r.sales for r in reports.sales_by_category(df).collect()}
    assert got == {"x": 0.5, "y": 0.0}


def test_visits_by_page_counts_sessions_once(spark):
    rows = [session("A", [ev(page_url="/a"), ev(page_url="/a"), ev(page_url="/b")]), session("B", [ev(page_url="/a")])]
    e = extract.events(parsed(spark, rows))
    got = {r.page_url: r.visits for r in reports.visits_by_page(e).collect()}
    assert got == {"/a": 2, "/b": 1}


def test_joins_semi_anti(spark):
    rows = [session("A", [ev("purchase", order_id="O", items=[{"product_id": "P"}])]), session("B", [ev()])]
    p = parsed(spark, rows)
    v, e, i = extract.visits(p), extract.events(p), extract.purchase_items(p)
    assert [r.session_id for r in reports.sessions_with_purchase(v, i).collect()] == ["A"]
    assert reports.orphans(e, v).count() == 0
    assert reports.orphans(e, v.where("session_id = 'A'")).count() == 1
    j = reports.events_with_visit(e, v).collect()
    assert all(r.visit_event_count == 1 for r in j)


def test_dedup_hot_group_of_copies(spark):
    base = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.col("id") % 7).alias("v"),
    )
    out = quality.dedup(base, ["k"])
    assert out.count() == 2001
    assert out.where("k = 'hot'").first().v == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan  # map-side combine before the shuffle


def test_key_report_and_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "session_id string")
    r = quality.key_report({"visits": df}).first()
    assert (r.row_count, r.key_count, r.duplicated_keys, r.extra_rows) == (3, 2, 1, 1)
    assert quality.duplicate_keys(df, ["session_id"]).first().copies == 2


def test_union_paths_and_reconciliation(spark):
    a = spark.createDataFrame([("s1", 1), ("s2", 2)], "session_id string, x int")
    b = spark.createDataFrame([("s2", 2), ("s3", 3)], "session_id string, x int")
    assert quality.union_paths(a, b, keys=["session_id"]).count() == 3
    got = sorted((r.session_id, r.only_in) for r in quality.path_reconciliation(a, b).collect())
    assert got == [("s1", "batch"), ("s3", "live")]


def test_profile_diff(spark):
    rows = [session("S", [ev(), ev("purchase", order_id="O"), ev("error")])]
    p = parsed(spark, rows)
    d = quality.profile_diff(extract.events(p, "batch"), extract.events(p, "live"), ["session_id", "event_type"])
    assert sorted((r.event_type, r.only_in) for r in d.collect()) == [("error", "batch"), ("purchase", "batch")]


def test_cart_before_purchase_and_reconciliation(spark):
    rows = [session("S", [
        ev("add_item_to_cart", product_id="P1", price=10.0, quantity=2),
        ev("page_view"),
        ev("add_item_to_cart", product_id="P2", price=0.1, quantity=3),
        ev("purchase", order_id="O1", amount=20.3, items=[{"product_id": "P1", "price": 10.0, "quantity": 2},
                                                          {"product_id": "P2", "price": 0.1, "quantity": 3}]),
        ev("add_item_to_cart", product_id="P3", price=5.0, quantity=1),
        ev("purchase", order_id="O2", amount=99.0, items=[]),
    ])]
    p = parsed(spark, rows)
    c = {r.order_id: (r.cart_adds, r.cart_quantity, r.cart_value) for r in orders.cart_before_purchase(p).collect()}
    assert c == {"O1": (2, 5, 20.3), "O2": (3, 6, 25.3)}
    rec = {r.order_id: (r.item_total, r.difference, r.matches)
           for r in orders.order_reconciliation(extract.events(p), extract.purchase_items(p)).collect()}
    assert rec == {"O1": (20.3, 0.0, True), "O2": (0.0, 99.0, False)}


def test_sort_session_events_stable(spark):
    rows = [session("S", [ev("a", timestamp="2024-01-02"), ev("b", timestamp="2024-01-01"),
                          ev("c", timestamp="2024-01-02")])]
    s = orders.sort_session_events(parsed(spark, rows)).first()
    assert [e.event.event_type for e in s.rec.events] == ["b", "a", "c"]


def test_assemble_sessions_splits_hot_session(spark):
    evs = [ev(timestamp=f"2024-01-01T00:00:{i:02d}", page_url=f"u{i}") for i in range(50)]
    flat = extract.events(parsed(spark, [session("HOT", evs), session("COLD", evs[:3])]))
    rec = orders.assemble_sessions(flat, max_events_per_record=10)
    assert rec.where("session_id = 'HOT'").count() == 5 and rec.where("session_id = 'COLD'").count() == 1
    whole = orders.assemble_sessions(flat)
    frames = [parse_sessions(r.select("value", F.col("session_id").alias("source"))) for r in (rec, whole)]
    assert frames[0].agg(F.max(F.size("rec.events"))).first()[0] == 10
    # parts decode to the same visits and events, ids included, as the whole
    for f in (extract.visits, extract.events):
        a, b = (sorted(map(str, f(x).collect())) for x in frames)
        assert a == b
    assert {r.session_id: r.event_count for r in extract.visits(frames[0]).collect()} == {"HOT": 50, "COLD": 3}


def test_copies_of_parts_count_once(spark):
    evs = [ev(timestamp=f"2024-01-01T00:00:{i:02d}") for i in range(6)]
    parts = [session("S", evs[2 * k : 2 * k + 2], part=k, parts=3, first_event_pos=2 * k) for k in (0, 1, 2, 1)]
    v = extract.visits(parsed(spark, parts)).collect()
    assert [(r.session_id, r.event_count, str(r.start_timestamp), str(r.end_timestamp)) for r in v] == [("S", 6, "2024-01-01 00:00:00", "2024-01-01 00:00:05")]
    assert sorted(r.event_pos for r in extract.exploded_events(parsed(spark, parts[:3])).collect()) == list(range(6))


def test_cart_totals_go_on_between_parts(spark):
    cart = lambda q: ev("add_item_to_cart", product_id="p", price=9.999, quantity=q)
    buy = lambda o: ev("purchase", order_id=o)
    events = [cart(100), buy("a"), cart(1), cart(2), buy("b"), buy("c"), cart(5), buy("d")]
    whole = [session("S", events)]
    parts = [session("S", events[2 * k : 2 * k + 2], part=k, parts=4, first_event_pos=2 * k) for k in range(4)]
    a, b = (sorted(orders.cart_before_purchase(parsed(spark, x)).collect()) for x in (whole, parts))
    assert a == b
    assert [(r.order_id, r.cart_adds, r.cart_quantity, r.cart_value) for r in a] == [("a", 1, 100, 999.9), ("b", 3, 103, 1029.9), ("c", 3, 103, 1029.9), ("d", 4, 108, 1079.89)]


def test_numbers_that_no_type_holds(spark):
    it = lambda p, q, c="c": {"product_id": "p", "category": c, "price": p, "quantity": q}
    rows = [session("S", [ev("purchase", order_id="o", items=[it(9.999, 100), it("1e30", 2, "huge"), it(1, 9 * 10**18), it(1, 9 * 10**18), it("NaN", 1), it("x", 1), it(None, None)])])]
    items = extract.purchase_items(parsed(spark, rows))
    assert [r.item_index_in_order for r in items.orderBy("item_index_in_order").collect()] == [0, 1, 2, 3, 6]
    assert [(r.reason, r.item_pos) for r in extract.rejects(parsed(spark, rows)).orderBy("item_pos").collect()] == [("bad_number", 4), ("bad_number", 5)]
    assert {r.category: r.sales for r in reports.sales_by_category(items).collect()} == {"c": 1.8e19 + 999.9, "huge": 2e30}
    assert [r.total_quantity for r in reports.popular_items(items).collect()] == [None]
    assert orders.order_amounts(items.where("category is null or item_index_in_order = 0")).first().item_total == 999.9


def test_split_hot_groups_bounds_groups(spark):
    df = spark.range(0, 2000).select(
        F.when(F.col("id") < 1500, F.lit(1)).otherwise(F.col("id")).alias("k"), "id"
    ).repartition(7)
    out = skew.split_hot_groups(df, ["k"], 100, ["id"])
    cut = out.where("k = 1").groupBy("part").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"), F.max("parts").alias("parts"))
    assert [tuple(r) for r in cut.orderBy("part").collect()] == [(i, 100 * i, 100 * i + 99, 100, 15) for i in range(15)]
    assert out.where("k <> 1 and part is null and parts is null").count() == 500
    assert out.count() == 2000


def test_hot_session_is_split_in_the_joins(spark):
    """A third of all rows on one key, broadcasts off: AQE must be able to split each join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sid = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 5000).cast("string")))
        base = spark.range(0, 60000, 1, 8).select(sid.alias("session_id"), F.sha2(F.col("id").cast("string"), 256).alias("event_unique_id"), F.lit("purchase").alias("event_type"), F.col("session_id").alias("order_id"), F.rand(1).alias("amount"), F.lit(1.0).alias("price"), F.lit(1).cast("long").alias("quantity"), "id")
        visits = base.select("session_id").distinct().select("session_id", *(F.lit("x").alias(c) for c in ("user_id", "device_type", "geolocation", "user_agent")), *(F.lit("2024-01-01").cast("timestamp").alias(c) for c in ("start_timestamp", "end_timestamp")), F.lit(1).cast("long").alias("event_count"))
        joins = {
            "J1": (reports.events_with_visit(base, visits), 60000),
            "J2": (reports.items_with_visit(base, visits), 60000),
            "J3": (reports.orphans(base, visits.where("session_id <> 's1'")), base.where("session_id = 's1'").count()),
            "R3": (orders.order_reconciliation(base, base.limit(1000)), 60000),
            "split": (skew.split_hot_groups(base, ["session_id"], 15, ["id"]).where("part is null"), base.join(base.groupBy("session_id").count().where("count <= 15"), "session_id").count()),
        }
        for name, (df, n) in joins.items():
            got = df.toLocalIterator()
            assert sum(1 for _ in got) == n, name
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan, f"{name}: {plan}"
        # J4 keeps visits (one row a session): its other side is one row a session as well
        assert reports.sessions_with_purchase(visits, base).count() == visits.count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_consolidate_visits_copies_and_parts(spark):
    rows = [
        ("S", "u", "d", "g", "a", "2024-01-01 10:00:00", "2024-01-01 10:05:00", 3, 0, 3),
        ("S", "u", "d", "g", "a", "2024-01-01 10:00:00", "2024-01-01 10:05:00", 3, 0, 3),  # replayed copy
        ("S", "u", "d", "g", "a", "2024-01-01 11:00:00", "2024-01-01 11:30:00", 2, 1, 3),  # second part
        ("S", "u", "d", "g", "a", "2024-01-01 11:00:00", "2024-01-01 11:30:00", 2, 2, 3),  # of equal times and size
        ("T", None, "m", None, None, None, None, 0, None, None),
        ("U", "u", "d", "g", "a", "2024-01-01 10:00:00", "2024-01-01 11:00:00", 4, None, None),  # whole by one path
        ("U", "u", "d", "g", "a", "2024-01-01 10:00:00", "2024-01-01 10:30:00", 2, 0, 2),  # in parts by the other
        ("U", "u", "d", "g", "a", "2024-01-01 10:40:00", "2024-01-01 11:00:00", 2, 1, 2),
    ]
    df = spark.createDataFrame(rows, "session_id string, user_id string, device_type string, geolocation string, "
                               "user_agent string, start_timestamp string, end_timestamp string, event_count long, part long, parts long")
    df = df.withColumn("start_timestamp", F.col("start_timestamp").cast("timestamp")).withColumn(
        "end_timestamp", F.col("end_timestamp").cast("timestamp"))
    got = {r.session_id: (str(r.start_timestamp), str(r.end_timestamp), r.event_count)
           for r in quality.consolidate_visits(df).collect()}
    assert got == {"S": ("2024-01-01 10:00:00", "2024-01-01 11:30:00", 7), "T": ("None", "None", 0), "U": ("2024-01-01 10:00:00", "2024-01-01 11:00:00", 4)}


def test_short_hot_groups_are_placed_by_a_window(spark, monkeypatch):
    """F8: only keys that one task should not place are range-partitioned and written; both ways give the same parts."""
    rows = [("a", i, f"x{i}") for i in range(7)] + [("b", i, "y") for i in range(3)] + [("c", 1, "z"), (None, 5, "n"), (None, 6, "n"), (None, 7, "n")]
    df = spark.createDataFrame(rows, "k string, v long, w string").repartition(3)
    ways, seen = [], []
    numbered = skew.numbered
    monkeypatch.setattr(skew, "numbered", lambda d, *a: seen.append(sorted({r.k for r in d.collect()})) or numbered(d, *a))
    for most in (10_000, 5, 1):  # all by a window, the longest numbered, all numbered
        monkeypatch.setattr(skew, "MOST_WINDOW_ROWS", most)
        out = skew.split_hot_groups(df, ["k"], 2, ["v"], pos_col="at", of_key={"top": F.max("v")})
        ways.append(sorted((tuple(r) for r in out.select("k", "v", "w", "part", "parts", "at", "top").collect()), key=str))
    assert seen == [["a"], ["a", "b"]]
    assert ways[0] == ways[1] == ways[2]
    want = [("a", i, f"x{i}", i // 2, 4, i, 6) for i in range(7)] + [("b", i, "y", i // 2, 2, i, 2) for i in range(3)]
    want += [(*r, None, None, None, None) for r in rows[10:]]
    assert ways[0] == sorted(want, key=str)
