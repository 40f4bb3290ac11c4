"""Tables laid out by session: equal joins without a shuffle, hot sessions split, states shown as a whole."""

import pytest
from pyspark.sql import functions as F

from clickweave.operators import reports
from clickweave.schemas import EVENTS, PURCHASE_ITEMS, VISITS
from clickweave.sinks import by_session
from clickweave.sinks import tables as sinks

HOT, BOUND = 400, 50


def made(spark, n=900, hot=HOT):
    """Events and items of many sessions, one of which holds a third of all rows and more; some have no visit, some no items."""
    i = F.col("id")
    sid = F.when(i < hot, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 97).cast("string")))
    rows = spark.range(n)
    ts = F.timestamp_seconds(F.lit(1704067200) + i % 13)
    have = {"session_id": sid, "event_unique_id": F.concat(F.lit("e"), i.cast("string")), "event_type": F.lit("page_view"), "timestamp": ts,
            "order_id": F.concat(F.lit("o"), (i % 7).cast("string")), "item_index_in_order": i, "product_id": F.lit("p")}

    def shaped(df, schema):
        return df.select(*(have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))

    sessions = rows.select(sid.alias("s")).where("s <> 's5'").distinct()
    visits = sessions.select(*(F.col("s") if f.name == "session_id" else F.lit("1" if f.name == "event_count" else None).cast(f.dataType).alias(f.name) for f in VISITS.fields)).toDF(*VISITS.names)
    return {"visits": visits, "events": shaped(rows, EVENTS), "purchase_items": shaped(rows.where("id % 97 > 30 or id < 120"), PURCHASE_ITEMS)}


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def published(spark):
    sinks.provision(spark, "bysess_t")
    tables = {t: df.cache() for t, df in made(spark).items()}
    by_session.publish(spark, "bysess_t", 6, BOUND, tables)
    return tables


def test_joins_are_equal(spark, published):
    v, e, i = (published[t] for t in ("visits", "events", "purchase_items"))
    assert rows_of(by_session.visits(spark, "bysess_t")) == rows_of(v)
    assert rows_of(by_session.events_with_visit(spark, "bysess_t")) == rows_of(reports.events_with_visit(e, v))
    assert rows_of(by_session.items_with_visit(spark, "bysess_t")) == rows_of(reports.items_with_visit(i, v))
    assert rows_of(by_session.sessions_with_purchase(spark, "bysess_t")) == rows_of(reports.sessions_with_purchase(v, i))


def test_joins_shuffle_nothing(spark, published):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (by_session.events_with_visit, by_session.items_with_visit, by_session.sessions_with_purchase):
            df = join(spark, "bysess_t")
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_sessions_are_split(spark, published):
    tables = by_session.read(spark, "bysess_t")
    for t in ("events", "purchase_items"):
        assert tables[t].count() == published[t].count()
        sizes = tables[t].groupBy(*by_session.KEYS).count()
        assert sizes.agg(F.max("count")).first()[0] <= BOUND
    assert tables["events"].where("session_id = 'hot'").select("salt").distinct().count() == HOT // BOUND
    # a visit for each salt, one for all others
    assert tables["visits"].where("session_id = 'hot'").count() == HOT // BOUND
    assert tables["visits"].where("session_id <> 'hot'").groupBy("session_id").count().where("count > 1").isEmpty()
    # one file a bucket
    assert len(tables["events"].inputFiles()) <= 6


def test_states(spark, monkeypatch):
    database = "bysess_states"
    sinks.provision(spark, database)
    some = made(spark, 60, 10)
    by_session.publish(spark, database, 3, BOUND)  # nothing is loaded
    assert by_session.events_with_visit(spark, database).isEmpty() and by_session.sessions_with_purchase(spark, database).isEmpty()
    sinks.write_load(spark, {"visits": some["visits"].withColumns({"part": F.lit(None).cast("long"), "parts": F.lit(None).cast("long")}), "events": some["events"], "purchase_items": some["purchase_items"]}, database, "a")
    assert by_session.events_with_visit(spark, database).isEmpty()  # not published yet
    first = by_session.publish(spark, database, 3, BOUND)
    assert by_session.events_with_visit(spark, database).count() == 60
    # a state that fails while it is written is never seen
    real = by_session._name

    def fail(database, table, state):
        if table == "visits":
            raise OSError("lost")
        return real(database, table, state)

    monkeypatch.setattr(by_session, "_name", fail)
    with pytest.raises(OSError):
        by_session.publish(spark, database, 3, BOUND, made(spark, 10, 1))
    monkeypatch.undo()
    assert by_session.read(spark, database)["events"].count() == 60
    last = by_session.publish(spark, database, 2, BOUND)
    dropped = by_session.drop_old(spark, database, keep=1)
    assert first in dropped and last not in dropped and by_session.visits(spark, database).count() == some["visits"].count()
    with pytest.raises(ValueError):
        by_session.drop_old(spark, database, keep=0)
