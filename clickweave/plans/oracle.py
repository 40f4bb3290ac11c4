"""DuckDB oracle SQL for the registered queries.

The oracle never builds JSON: it applies the base-table -> session mapping
(``sources.derived``) and each operator's definition directly to the
driver's tables, so a bug in decoding or flattening shows up as a
mismatch. Views ``events``, ``lineitem``, ``part`` ... are pre-registered
by the driver.
"""

from __future__ import annotations

# Shared CTEs: ev = one row per base event with its session, position and
# mapped details; items = one row per purchased lineitem with its index.
_EV = """
ev AS (
  SELECT
    e.event_id, e.ts, e.user_id,
    CASE e.event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_item_to_cart'
         WHEN 'signup' THEN 'promo_click' WHEN 'purchase' THEN 'purchase' ELSE e.event_type END AS etype,
    'SID-' || CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') AS session_id,
    'UID-' || CAST(e.user_id AS VARCHAR) AS uid,
    (['mobile', 'desktop', 'tablet'])[(e.user_id % 3) + 1] AS device_type,
    printf('%.6f,%.6f', CAST((e.user_id * 7) % 180 - 90 + 0.5 AS DOUBLE), CAST((e.user_id * 13) % 360 - 180 + 0.25 AS DOUBLE)) AS geolocation,
    'ua-' || CAST(e.user_id % 4 AS VARCHAR) AS user_agent,
    strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text,
    CAST(row_number() OVER (PARTITION BY e.user_id, strftime(e.ts, '%Y%m%d') ORDER BY e.ts, e.event_id) - 1 AS BIGINT) AS pos
  FROM events e
),
evd AS (
  SELECT ev.*,
    CASE WHEN etype = 'page_view' THEN 'https://example.com/p/' || CAST(event_id % 20 AS VARCHAR)
         WHEN etype = 'promo_click' THEN 'https://example.com/promo/' || CAST(event_id % 7 AS VARCHAR) END AS page_url,
    CASE WHEN etype = 'page_view' AND event_id % 5 <> 0
         THEN 'https://example.com/p/' || CAST((event_id * 7) % 20 AS VARCHAR) END AS referrer_url,
    CASE WHEN etype = 'add_item_to_cart' THEN 'P-' || CAST(event_id % np.n AS VARCHAR) END AS product_id,
    CASE WHEN etype = 'add_item_to_cart' THEN p.p_name END AS product_name,
    CASE WHEN etype = 'add_item_to_cart' THEN p.p_type END AS category,
    CASE WHEN etype = 'add_item_to_cart' THEN p.p_retailprice END AS price,
    CASE WHEN etype = 'add_item_to_cart' THEN CAST(event_id % 5 + 1 AS BIGINT) END AS quantity,
    CASE WHEN etype = 'purchase' THEN 'ORD-' || CAST(event_id AS VARCHAR) END AS order_id,
    CASE WHEN etype = 'purchase' THEN 'USD' END AS currency
  FROM ev CROSS JOIN (SELECT count(*) AS n FROM part) np LEFT JOIN part p ON etype = 'add_item_to_cart' AND p.p_partkey = ev.event_id % np.n
),
items AS (
  SELECT l.l_orderkey,
    CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber NULLS FIRST, l.l_partkey NULLS FIRST,
      l.l_suppkey NULLS FIRST, l.l_quantity NULLS FIRST, l.l_extendedprice NULLS FIRST, l.l_discount NULLS FIRST,
      l.l_tax NULLS FIRST, l.l_returnflag NULLS FIRST, l.l_linestatus NULLS FIRST, l.l_shipdate NULLS FIRST) - 1 AS BIGINT) AS item_index,
    'P-' || CAST(l.l_partkey AS VARCHAR) AS product_id, p.p_name AS product_name, p.p_type AS category,
    p.p_retailprice AS price, CAST(l.l_quantity AS BIGINT) AS quantity
  FROM lineitem l LEFT JOIN part p ON p.p_partkey = l.l_partkey
  WHERE l.l_orderkey IN (SELECT event_id FROM events WHERE event_type = 'purchase')
),
amounts AS (
  SELECT l_orderkey, round(sum(price * quantity), 2) AS amount
  FROM items GROUP BY l_orderkey
),
evf AS (
  SELECT evd.*, CASE WHEN etype = 'purchase' THEN coalesce(a.amount, 0.0) END AS amount
  FROM evd LEFT JOIN amounts a ON etype = 'purchase' AND a.l_orderkey = evd.event_id
),
pitems AS (
  SELECT 'ORD-' || CAST(ev.event_id AS VARCHAR) AS order_id, i.item_index AS item_index_in_order, ev.session_id,
    i.product_id, i.product_name, i.category, i.price, i.quantity, ev.ts AS purchase_event_timestamp
  FROM ev JOIN items i ON i.l_orderkey = ev.event_id
  WHERE ev.etype = 'purchase'
),
sess AS (
  SELECT session_id, any_value(uid) AS user_id, any_value(device_type) AS device_type,
    any_value(geolocation) AS geolocation, any_value(user_agent) AS user_agent,
    min(ts) AS start_timestamp, max(ts) AS end_timestamp, count(*) AS event_count,
    max(ts) AS publish_time,
    count(*) FILTER (WHERE etype = 'page_view') AS page_views
  FROM ev GROUP BY session_id
)
"""

_EVENTS_COLS = """
  session_id, sha256(session_id || '|' || CAST(pos AS VARCHAR) || '|' || etype || '|' || ts_text) AS event_unique_id,
  etype AS event_type, ts AS "timestamp", page_url, referrer_url, product_id, product_name, category,
  price, quantity, order_id, amount, currency, device_type, uid AS user_id
"""

LIVE_TYPES_SQL = "('page_view', 'add_item_to_cart', 'remove_item_from_cart', 'view_item', 'promo_view', 'promo_click')"


def _with(body: str) -> str:
    return "WITH " + _EV + body


ORACLES: dict[str, str] = {
    "visits_by_page": _with("""
SELECT page_url, count(DISTINCT session_id) AS visits
FROM evd WHERE etype = 'page_view' GROUP BY page_url
"""),
    "visits": _with("""
SELECT session_id, user_id, device_type, geolocation, user_agent, start_timestamp, end_timestamp,
  CAST(event_count AS BIGINT) AS event_count
FROM sess
"""),
    "events_batch": _with(f"SELECT {_EVENTS_COLS} FROM evf WHERE etype IS NOT NULL"),
    "events_live": _with(f"SELECT {_EVENTS_COLS} FROM evf WHERE etype IN {LIVE_TYPES_SQL}"),
    "purchase_items_batch": _with("SELECT * FROM pitems"),
    "purchase_items_live": _with("SELECT * FROM pitems"),
    "rejects_batch": _with("""
SELECT 'event' AS stage, 'missing_type_or_timestamp' AS reason, session_id, CAST(pos AS INTEGER) AS event_pos,
  CAST(NULL AS INTEGER) AS item_pos
FROM ev WHERE etype IS NULL
"""),
    "rejects_live": _with(f"""
SELECT 'event' AS stage,
  CASE WHEN etype IS NULL THEN 'missing_type_or_timestamp' ELSE 'unknown_event_type' END AS reason,
  session_id, CAST(pos AS INTEGER) AS event_pos, CAST(NULL AS INTEGER) AS item_pos
FROM ev WHERE etype IS NULL OR (etype NOT IN {LIVE_TYPES_SQL} AND etype <> 'purchase')
"""),
}

_EVB = f"SELECT {_EVENTS_COLS} FROM evf WHERE etype IS NOT NULL"
_VISITS = """SELECT session_id, user_id, device_type, geolocation, user_agent, start_timestamp, end_timestamp,
  CAST(event_count AS BIGINT) AS event_count FROM sess"""
# Page-view windows: 60 minutes, epoch-aligned, on the record's publish time.
_PV = """SELECT time_bucket(INTERVAL 60 MINUTE, publish_time, TIMESTAMP '1970-01-01') + INTERVAL 60 MINUTE AS window_end,
  CAST(sum(page_views) AS BIGINT) AS page_view_count FROM sess GROUP BY 1 HAVING sum(page_views) > 0"""

ORACLES.update({
    "visits_by_device": _with("SELECT device_type, count(*) AS visits FROM sess GROUP BY device_type"),
    "popular_items": _with("""
SELECT product_id, CAST(sum(coalesce(quantity, 0)) AS BIGINT) AS total_quantity, count(*) AS order_lines
FROM pitems GROUP BY product_id ORDER BY total_quantity DESC, product_id ASC LIMIT 10
"""),
    "sales_by_category": _with("""
SELECT category,
  round(sum(coalesce(price * quantity, 0.0)), 2) AS sales,
  count(*) AS item_rows
FROM pitems GROUP BY category
"""),
    "events_with_visit": _with(f"""
SELECT e.*, s.start_timestamp AS visit_start, s.end_timestamp AS visit_end,
  CAST(s.event_count AS BIGINT) AS visit_event_count, s.geolocation
FROM ({_EVB}) e LEFT JOIN sess s USING (session_id)
"""),
    "items_with_visit": _with("""
SELECT i.*, s.user_id, s.device_type, s.start_timestamp AS visit_start
FROM pitems i LEFT JOIN sess s USING (session_id)
"""),
    "orphan_counts": _with(f"""
SELECT 'events' AS table_name, count(*) AS orphan_rows
FROM ({_EVB}) e WHERE session_id NOT IN (SELECT session_id FROM sess)
UNION ALL
SELECT 'purchase_items' AS table_name, count(*) AS orphan_rows
FROM pitems WHERE session_id NOT IN (SELECT session_id FROM sess)
"""),
    "sessions_with_purchase": _with(f"""
SELECT * FROM ({_VISITS}) v WHERE session_id IN (SELECT session_id FROM pitems)
"""),
    "key_report": _with(f"""
SELECT 'visits' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT) AS duplicated_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT) AS extra_rows
FROM (SELECT session_id, count(*) AS n FROM sess GROUP BY 1)
UNION ALL
SELECT 'events', CAST(sum(n) AS BIGINT), count(*), CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT),
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT)
FROM (SELECT session_id, event_unique_id, count(*) AS n FROM ({_EVB}) GROUP BY 1, 2)
UNION ALL
SELECT 'purchase_items', CAST(sum(n) AS BIGINT), count(*), CAST(coalesce(sum(CASE WHEN n > 1 THEN 1 END), 0) AS BIGINT),
  CAST(coalesce(sum(CASE WHEN n > 1 THEN n - 1 END), 0) AS BIGINT)
FROM (SELECT order_id, item_index_in_order, count(*) AS n FROM pitems GROUP BY 1, 2)
"""),
    "dedup_visits": _with(_VISITS),
    "union_paths_events": _with(_EVB),
    "path_reconciliation": _with(f"""
SELECT session_id, 'batch' AS only_in FROM evf WHERE etype IS NOT NULL
GROUP BY session_id HAVING count(*) FILTER (WHERE etype IN {LIVE_TYPES_SQL}) = 0
"""),
    "profile_diff": _with(f"""
SELECT session_id, event_unique_id, event_type, 'batch' AS only_in
FROM ({_EVB}) e WHERE event_type NOT IN {LIVE_TYPES_SQL}
"""),
    "order_amounts": _with("""
SELECT order_id,
  round(sum(coalesce(price * quantity, 0.0)), 2) AS item_total,
  count(*) AS item_rows
FROM pitems GROUP BY order_id
"""),
    "order_reconciliation": _with("""
SELECT p.order_id, p.session_id, p.amount AS stated_amount, coalesce(t.item_total, 0.0) AS item_total,
  CAST(coalesce(t.item_rows, 0) AS BIGINT) AS item_rows,
  round(coalesce(p.amount, 0.0) - coalesce(t.item_total, 0.0), 2) AS difference,
  abs(round(coalesce(p.amount, 0.0) - coalesce(t.item_total, 0.0), 2)) < 0.005 AS matches
FROM evf p
LEFT JOIN (
  SELECT order_id,
    round(sum(coalesce(price * quantity, 0.0)), 2) AS item_total,
    count(*) AS item_rows
  FROM pitems GROUP BY order_id) t USING (order_id)
WHERE p.etype = 'purchase'
"""),
    "cart_before_purchase": _with("""
SELECT p.session_id, p.order_id, p.pos AS purchase_pos,
  count(c.pos) AS cart_adds,
  CAST(coalesce(sum(c.quantity), 0) AS BIGINT) AS cart_quantity,
  round(coalesce(sum(c.price * c.quantity), 0.0), 2) AS cart_value
FROM evf p
LEFT JOIN evf c ON c.session_id = p.session_id AND c.etype = 'add_item_to_cart' AND c.pos < p.pos
WHERE p.etype = 'purchase'
GROUP BY p.session_id, p.order_id, p.pos
"""),
    "session_event_order": _with("""
SELECT session_id, CAST(pos AS INTEGER) AS event_pos, etype AS event_type, ts AS "timestamp" FROM ev
"""),
    "reassembled_visits": _with("""
SELECT session_id, user_id, device_type, start_timestamp, end_timestamp, CAST(event_count AS BIGINT) AS event_count
FROM sess
"""),
    "push_visits": _with(_VISITS),
    "page_views": _with(_PV),
    "page_view_alerts": _with(f"""
SELECT window_end, page_view_count, CAST(5 AS BIGINT) AS threshold FROM ({_PV}) WHERE page_view_count > 5
"""),
    "raw_landing_minutes": _with("""
SELECT strftime(date_trunc('minute', publish_time), '%Y-%m-%d-T-%H-%M') AS minute, count(*) AS messages
FROM sess GROUP BY 1
"""),
    "page_views_stream": _with(_PV),
    "events_live_stream": _with(f"SELECT {_EVENTS_COLS} FROM evf WHERE etype IN {LIVE_TYPES_SQL}"),
    "duplicate_visit_keys": _with("""
SELECT session_id, count(*) AS copies
FROM (SELECT session_id FROM sess UNION ALL SELECT session_id FROM sess)
GROUP BY session_id HAVING count(*) > 1
"""),
    "page_view_flags": _with(f"""
SELECT window_end, page_view_count, CAST(5 AS BIGINT) AS threshold, page_view_count > 5 AS is_alert FROM ({_PV})
"""),
    "consolidated_visits": _with(_VISITS),
    "raw_landing_stream": _with("""
SELECT strftime(date_trunc('minute', publish_time), '%Y-%m-%d-T-%H-%M') AS minute, count(*) AS messages
FROM sess GROUP BY 1
"""),
})

# Records with defects: the rules of sources.dirty on the base tables.
_DIRTY = _EV.rstrip() + """,
dev AS (
  SELECT evf.*, user_id % 10 AS kind, user_id % 20 AS kind20,
    CASE WHEN user_id % 10 = 3 AND pos % 2 = 0 THEN NULL ELSE etype END AS dtype,
    user_id % 10 = 4 AND pos % 3 = 0 AS no_time,
    user_id % 10 = 8 AND pos % 2 = 1 AND etype = 'add_item_to_cart' AS no_number,
    user_id % 10 = 5 AND etype = 'purchase' AS no_order
  FROM evf
),
ditems AS (
  SELECT e.*, i.item_index, CASE WHEN kind = 9 AND i.item_index = 0 THEN 'P-huge' WHEN kind = 9 AND i.item_index = 1 THEN 'P-many' ELSE i.product_id END AS d_product,
    i.product_name AS d_name,
    CASE WHEN kind = 9 AND i.item_index = 0 THEN 'huge' WHEN kind = 9 AND i.item_index = 1 THEN 'many' ELSE i.category END AS d_category,
    CASE WHEN kind = 9 AND i.item_index = 0 THEN pow(2.0, 100) WHEN kind = 9 AND i.item_index = 1 THEN 0.5
      WHEN kind = 0 THEN CAST(CAST(i.price AS VARCHAR) || '49' AS DOUBLE) ELSE i.price END AS d_price,
    CASE WHEN kind = 9 AND i.item_index = 0 THEN 1 WHEN kind = 9 AND i.item_index = 1 THEN 9000000000000000000 ELSE i.quantity END AS d_quantity,
    kind = 6 AND i.item_index % 2 = 0 AS no_product, kind = 6 AND i.item_index % 4 = 1 AS no_price
  FROM dev e JOIN items i ON i.l_orderkey = e.event_id WHERE e.dtype = 'purchase'
),
bitems AS (
  SELECT * FROM ditems WHERE kind NOT IN (1, 2, 5, 7) AND NOT no_product AND NOT no_price
)
"""


def _dirty_rejects(live: bool) -> str:
    """Rejects of lines (batch) or messages (live)."""
    gone = "(1, 2, 7)"
    utf = "kind20 = 9" if live else "false"
    event = f"""
  CASE WHEN dtype IS NULL THEN 'missing_type_or_timestamp' WHEN no_time THEN 'bad_timestamp' WHEN no_number THEN 'bad_number'
    {f"WHEN dtype NOT IN {LIVE_TYPES_SQL} THEN 'unknown_event_type'" if live else ""} END"""
    purchase = "CASE WHEN no_time THEN 'bad_timestamp' WHEN no_order THEN 'missing_order_id' END" if live else "CASE WHEN no_order THEN 'missing_order_id' END"
    return "WITH " + _DIRTY + f""",
good AS (SELECT * FROM dev WHERE kind NOT IN {gone} AND NOT {utf}),
recs AS (SELECT DISTINCT session_id, kind, kind20 FROM dev)
SELECT 'record' AS stage,
  CASE WHEN {utf} THEN 'bad_encoding' WHEN kind = 1 THEN 'bad_json' WHEN kind = 7 THEN '{"empty_message" if live else "bad_json"}' ELSE 'missing_session_id' END AS reason,
  CASE WHEN kind = 1 THEN session_id WHEN kind20 = 12 THEN '' END AS session_id,
  CAST(NULL AS INTEGER) AS event_pos, CAST(NULL AS INTEGER) AS item_pos
FROM recs WHERE kind IN {gone} OR {utf}
UNION ALL
SELECT 'event', reason, session_id, CAST(pos AS INTEGER), NULL FROM (SELECT *, {event} AS reason FROM good {"WHERE coalesce(dtype, '') <> 'purchase'" if live else ""}) WHERE reason IS NOT NULL
UNION ALL
SELECT 'purchase', reason, session_id, CAST(pos AS INTEGER), NULL FROM (SELECT *, {purchase} AS reason FROM good WHERE dtype = 'purchase') WHERE reason IS NOT NULL
UNION ALL
SELECT 'item', CASE WHEN no_product THEN 'missing_product_id' ELSE 'bad_number' END, session_id, CAST(pos AS INTEGER), CAST(item_index AS INTEGER)
FROM ditems WHERE kind NOT IN {gone} AND NOT {utf} AND (no_product OR no_price)
"""


_DIRTY_EVENTS = """
  SELECT session_id, sha256(session_id || '|' || CAST(pos AS VARCHAR) || '|' || etype || '|' || ts_text) AS event_unique_id,
    etype AS event_type, ts AS "timestamp", page_url, referrer_url, product_id, product_name, category,
    price, quantity, CASE WHEN NOT no_order THEN order_id END AS order_id, amount, currency, device_type, uid AS user_id
  FROM dev WHERE kind NOT IN (1, 2, 7) AND dtype IS NOT NULL AND NOT no_time AND NOT no_number
"""


def _dirty_items(where: str, ts: str) -> str:
    return f"""
  SELECT order_id, item_index AS item_index_in_order, session_id, d_product AS product_id, d_name AS product_name, d_category AS category,
    d_price AS price, d_quantity AS quantity, {ts} AS purchase_event_timestamp FROM bitems WHERE {where}
"""


_LOST = "user_id % 10 = 3"

ORACLES.update({
    "rejects_dirty_batch": _dirty_rejects(False),
    "rejects_dirty_live": _dirty_rejects(True),
    "visits_dirty": "WITH " + _DIRTY + """
SELECT session_id, any_value(uid) AS user_id, any_value(device_type) AS device_type, any_value(geolocation) AS geolocation,
  any_value(user_agent) AS user_agent, min(ts) FILTER (WHERE NOT no_time) AS start_timestamp,
  max(ts) FILTER (WHERE NOT no_time) AS end_timestamp, count(*) AS event_count
FROM dev WHERE kind NOT IN (1, 2, 7) GROUP BY session_id
""",
    "events_dirty": "WITH " + _DIRTY + _DIRTY_EVENTS,
    "items_dirty_batch": "WITH " + _DIRTY + _dirty_items("true", "CASE WHEN NOT no_time THEN ts END"),
    "items_dirty_live": "WITH " + _DIRTY + _dirty_items("NOT no_time AND kind20 <> 9", "ts"),
    "sales_dirty": "WITH " + _DIRTY + """
SELECT d_category AS category, CASE WHEN d_category IN ('huge', 'many') THEN round(sum(d_price * d_quantity), 2)
  ELSE CAST(round(sum(TRY_CAST(d_price AS DECIMAL(18, 6)) * TRY_CAST(d_quantity AS DECIMAL(14, 0))), 2) AS DOUBLE) END AS sales, count(*) AS item_rows
FROM bitems GROUP BY 1
""",
    "popular_items_dirty": "WITH " + _DIRTY + """
SELECT d_product AS product_id, TRY_CAST(sum(CAST(d_quantity AS HUGEINT)) AS BIGINT) AS total_quantity, count(*) AS order_lines
FROM bitems GROUP BY 1 ORDER BY total_quantity DESC NULLS LAST, product_id LIMIT 10
""",
    "order_reconciliation_dirty": "WITH " + _DIRTY + f""",
totals AS (SELECT order_id, CASE WHEN any_value(kind) = 9 THEN round(sum(d_price * d_quantity), 2)
  ELSE CAST(round(sum(TRY_CAST(d_price AS DECIMAL(18, 6)) * TRY_CAST(d_quantity AS DECIMAL(14, 0))), 2) AS DOUBLE) END AS item_total,
  count(*) AS item_rows FROM bitems GROUP BY 1)
SELECT order_id, session_id, amount AS stated_amount, coalesce(item_total, 0.0) AS item_total, coalesce(item_rows, 0) AS item_rows,
  round(amount - coalesce(item_total, 0.0), 2) AS difference, abs(round(amount - coalesce(item_total, 0.0), 2)) < 0.005 AS matches
FROM ({_DIRTY_EVENTS}) LEFT JOIN totals USING (order_id) WHERE event_type = 'purchase' AND order_id IS NOT NULL
""",
    "orphan_counts_dirty": _with(f"""
SELECT 'events' AS table_name, count(*) AS orphan_rows FROM ev WHERE etype IS NOT NULL AND {_LOST}
UNION ALL SELECT 'purchase_items', count(*) FROM ev JOIN items i ON i.l_orderkey = ev.event_id WHERE etype = 'purchase' AND {_LOST}
"""),
    "orphan_events": _with(f"""
SELECT e.session_id, e.event_unique_id, e."timestamp" FROM ({_EVB}) e WHERE CAST(substr(e.user_id, 5) AS BIGINT) % 10 = 3
"""),
    "key_report_twice": _with(f"""
SELECT 'visits' AS table_name, 2 * count(*) AS row_count, count(*) AS key_count, count(*) AS duplicated_keys, count(*) AS extra_rows FROM sess
UNION ALL
SELECT 'events', count(*) + count(*) FILTER (WHERE event_type IN {LIVE_TYPES_SQL}), count(*),
  count(*) FILTER (WHERE event_type IN {LIVE_TYPES_SQL}), count(*) FILTER (WHERE event_type IN {LIVE_TYPES_SQL}) FROM ({_EVB})
UNION ALL
SELECT 'purchase_items', count(*), count(*), 0, 0 FROM pitems
"""),
    "session_event_order_reversed": _with("""
SELECT session_id, CAST(row_number() OVER (PARTITION BY session_id ORDER BY ts, CASE WHEN user_id % 2 = 1 THEN -event_id ELSE event_id END) - 1 AS INTEGER) AS event_pos,
  etype AS event_type, ts AS "timestamp" FROM ev
"""),
})

_TABLE_ROWS = f"""
SELECT 'visits' AS table_name, user_id % 2 AS odd, strftime(min(ts), '%Y-%m-%d') AS day, 1 AS n, 0 AS live FROM ev GROUP BY session_id, user_id
UNION ALL SELECT 'events', user_id % 2, strftime(ts, '%Y-%m-%d'), 1, CASE WHEN etype IN {LIVE_TYPES_SQL} THEN 1 ELSE 0 END FROM ev WHERE etype IS NOT NULL
UNION ALL SELECT 'purchase_items', user_id % 2, strftime(ts, '%Y-%m-%d'), 1, 1 FROM ev JOIN items i ON i.l_orderkey = ev.event_id WHERE etype = 'purchase'
"""

ORACLES.update({
    "raw_landing_round_trip": _dirty_rejects(True),
    "tables_after_replay": _with(_VISITS),
    "tables_of_both_paths": _with(f"""
SELECT table_name, 'batch_sessions' AS load, count(*) AS row_count FROM ({_TABLE_ROWS}) WHERE odd = 0 GROUP BY 1
UNION ALL
SELECT table_name, 'live', count(*) FROM ({_TABLE_ROWS}) WHERE odd = 1 AND (table_name <> 'events' OR live = 1) GROUP BY 1
UNION ALL
SELECT 'rejects', 'live', count(*) FROM ev WHERE user_id % 2 = 1 AND etype NOT IN {LIVE_TYPES_SQL} AND etype <> 'purchase'
"""),
    "days_replaced": _with(f"""
SELECT table_name, day, count(*) AS row_count FROM ({_TABLE_ROWS}) WHERE odd = 0 OR CAST(substr(day, 9) AS INTEGER) % 10 <> 3 GROUP BY 1, 2
"""),
    "tables_truncated": _with(f"""
SELECT table_name, count(*) AS row_count FROM ({_TABLE_ROWS}) WHERE odd = 1 GROUP BY 1
"""),
    "job_run_metrics": "WITH " + _DIRTY + f""",
recs AS (SELECT DISTINCT session_id, kind FROM dev WHERE kind <> 0),
counts AS (
  SELECT (SELECT count(*) FROM recs) AS input_records, (SELECT count(*) FROM recs WHERE kind IN (1, 2, 7)) AS record_rejects,
    (SELECT count(*) FROM ({_DIRTY_EVENTS.rstrip()} AND kind <> 0)) AS events_rows, (SELECT count(*) FROM bitems WHERE kind <> 0) AS items,
    (SELECT count(*) FROM dev WHERE kind NOT IN (0, 1, 2, 7) AND (dtype IS NULL OR no_time OR no_number)) AS e,
    (SELECT count(*) FROM dev WHERE kind = 5 AND etype = 'purchase') AS p,
    (SELECT count(*) FROM ditems WHERE kind = 6 AND (no_product OR no_price)) AS i
)
SELECT 'SUCCEEDED' AS status, 'input_records' AS metric, input_records AS value FROM counts
UNION ALL SELECT 'SUCCEEDED', 'record_rejects', record_rejects FROM counts
UNION ALL SELECT 'SUCCEEDED', 'visits_rows', input_records - record_rejects FROM counts
UNION ALL SELECT 'SUCCEEDED', 'events_rows', events_rows FROM counts
UNION ALL SELECT 'SUCCEEDED', 'purchase_items_rows', items FROM counts
UNION ALL SELECT 'SUCCEEDED', 'rejects_rows', record_rejects + e + p + i FROM counts
UNION ALL SELECT 'LEFT', 'files', 0
""",
    "live_dashboard_stream": _with("""
SELECT 'visits_by_device' AS report, device_type AS group_key, CAST(count(*) AS DOUBLE) AS value FROM sess GROUP BY 2
UNION ALL SELECT 'product_totals', product_id, CAST(sum(coalesce(quantity, 0)) AS DOUBLE) FROM pitems GROUP BY 2
UNION ALL SELECT 'sales_by_category', category, round(sum(coalesce(price * quantity, 0.0)), 2) FROM pitems GROUP BY 2
UNION ALL SELECT 'visits_by_page', page_url, CAST(count(DISTINCT session_id) AS DOUBLE) FROM evd WHERE etype = 'page_view' GROUP BY 2
"""),
})

_UID = "CAST(substr(user_id, 5) AS BIGINT)"
_LIVE_REJECTS = f"SELECT * FROM ev WHERE etype NOT IN {LIVE_TYPES_SQL} AND etype <> 'purchase'"

ORACLES.update({
    "iso_timestamps": """
SELECT event_id, event_id % 16 AS form, CASE event_id % 16
  WHEN 0 THEN ts WHEN 1 THEN ts WHEN 2 THEN date_trunc('hour', ts) WHEN 3 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('minute', ts)
  WHEN 5 THEN date_trunc('week', ts) WHEN 6 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
  WHEN 7 THEN date_trunc('millisecond', ts) + INTERVAL 1439 MINUTE WHEN 8 THEN date_trunc('second', ts) - INTERVAL 3723500 MILLISECOND
  WHEN 12 THEN ts WHEN 14 THEN TIMESTAMP '2021-01-03' END AS read_as
FROM events
""",
    "consolidated_parts": _with(_VISITS),
    "visits_of_parts_stream": _with(_VISITS),
    "late_page_views_stream": _with(f"""
SELECT *, on_time > 5 AS is_alert FROM (
  SELECT time_bucket(INTERVAL 60 MINUTE, publish_time, TIMESTAMP '1970-01-01') + INTERVAL 60 MINUTE AS window_end,
    CAST(coalesce(sum(page_views) FILTER (WHERE {_UID} % 7 <> 3), 0) AS BIGINT) AS on_time,
    CAST(coalesce(sum(page_views) FILTER (WHERE {_UID} % 7 = 3), 0) AS BIGINT) AS late
  FROM sess GROUP BY 1 HAVING sum(page_views) > 0)
"""),
    "raw_landing_messages": _with(f"""
SELECT session_id || '#0' AS message_id, CASE WHEN {_UID} % 5 <> 0 THEN publish_time END AS publish_time,
  CAST(CASE WHEN {_UID} % 2 = 1 THEN 3 ELSE 1 END AS INTEGER) AS n_attributes,
  CASE WHEN {_UID} % 2 = 1 THEN 'b,a' ELSE '' END AS headers, true AS in_its_shard, true AS has_data
FROM sess
"""),
    "live_job_runs": _with(f"""
SELECT 'live' AS job_name, metric, value FROM (
  SELECT 'visits_rows' AS metric, count(*) AS value FROM sess
  UNION ALL SELECT 'input_records', count(*) FROM sess
  UNION ALL SELECT 'record_rejects', 0
  UNION ALL SELECT 'events_rows', count(*) FROM ev WHERE etype IN {LIVE_TYPES_SQL}
  UNION ALL SELECT 'purchase_items_rows', count(*) FROM pitems
  UNION ALL SELECT 'rejects_rows', count(*) FROM ({_LIVE_REJECTS})
)
"""),
    "failed_load": _with(f"""
SELECT state, t AS table_name, count(table_name) AS row_count
FROM (VALUES ('failed', 0), ('retried', 1)) s(state, upto), (VALUES ('visits'), ('events'), ('purchase_items'), ('rejects')) x(t)
LEFT JOIN ({_TABLE_ROWS}) r ON r.table_name = x.t AND r.odd <= s.upto
GROUP BY 1, 2
"""),
    "archived_once": _with("""
SELECT 'visits' AS what, count(*) AS n FROM sess
UNION ALL SELECT 'events', count(*) FROM ev WHERE etype IS NOT NULL
UNION ALL SELECT 'purchase_items', count(*) FROM pitems
UNION ALL SELECT 'left', 0 UNION ALL SELECT 'archived', 10 UNION ALL SELECT 'loaded', 10
"""),
    "compacted_tables": _with(f"""
SELECT table_name, row_count, 1::BIGINT AS most_loads_a_day FROM (
  SELECT 'visits' AS table_name, count(*) AS row_count FROM sess
  UNION ALL SELECT 'events', count(*) FROM ev WHERE etype IN {LIVE_TYPES_SQL}
  UNION ALL SELECT 'purchase_items', count(*) FROM pitems
  UNION ALL SELECT 'rejects', count(*) FROM ({_LIVE_REJECTS})
)
"""),
})


def _derived(state: str, version: int, gone: str, mended: str) -> str:
    """Rows by table and session of lines with defects; ``gone`` are the kinds of records that are lost, ``mended`` the rejects that are not."""
    return f"""
SELECT '{state}' AS state, table_name, session_id, {version}::BIGINT AS decoder_version, count(*) AS n FROM (
  SELECT 'visits' AS table_name, session_id FROM dev WHERE kind NOT IN {gone}
  UNION ALL SELECT 'events', session_id FROM dev WHERE kind NOT IN {gone} AND dtype IS NOT NULL AND NOT no_time AND NOT no_number
  UNION ALL SELECT 'purchase_items', session_id FROM ditems WHERE kind <> 5 AND kind NOT IN {gone} AND NOT no_product AND NOT no_price
  UNION ALL SELECT 'rejects', session_id FROM lost WHERE NOT {mended}
) GROUP BY 2, 3"""


ORACLES["curated_from_raw"] = "WITH " + _DIRTY + f""",
lost AS ({_dirty_rejects(False)})
{_derived("landed", 1, "(1, 2, 7)", "false")}
UNION ALL {_derived("decoded again", 2, "(2, 7)", "(reason = 'bad_json' AND session_id IS NOT NULL)")}
UNION ALL SELECT 'landed', 'derived', NULL, NULL, 1
UNION ALL SELECT 'decoded again', 'derived', NULL, NULL, 2
"""

_WRITER = "CASE WHEN uid_no % 2 = 0 THEN 'batch_sessions-1' WHEN uid_no % 3 = 0 AND is_live THEN 'live-0' ELSE 'batch_sessions-2' END"
ORACLES["loads_without_copies"] = _with(f"""
SELECT table_name, session_id, {_WRITER} AS load_id, count(*) AS n FROM (
  SELECT 'visits' AS table_name, session_id, true AS is_live, {_UID} AS uid_no FROM sess
  UNION ALL SELECT 'events', session_id, coalesce(etype IN {LIVE_TYPES_SQL}, false), user_id FROM ev WHERE etype IS NOT NULL
  UNION ALL SELECT 'purchase_items', p.session_id, true, {_UID} FROM pitems p JOIN sess USING (session_id)
) GROUP BY 1, 2, 3
""")
ORACLES["joins_by_session"] = _with("""
SELECT 'J1' AS join_name, session_id, count(*) AS n, min(start_timestamp) AS visit_start, CAST(sum(event_count) AS BIGINT) AS value
FROM ev JOIN sess USING (session_id) WHERE etype IS NOT NULL GROUP BY 2
UNION ALL SELECT 'J2', session_id, count(*), min(start_timestamp), CAST(sum(length(device_type)) AS BIGINT) FROM pitems JOIN sess USING (session_id) GROUP BY 2
UNION ALL SELECT 'J4', session_id, 1, start_timestamp, event_count FROM sess WHERE session_id IN (SELECT session_id FROM pitems)
""")
