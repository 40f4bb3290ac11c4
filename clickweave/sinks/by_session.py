"""Curated tables laid out by session, for joins without a shuffle.

The curated tables lie by day, as loads and date filters want them; every join
of events or items with visits shuffles both sides by session. ``publish`` writes
the three tables a second time, bucketed and sorted by ``session_id`` and
``salt``, so that any number of such joins read bucket against bucket.

``salt`` splits hot sessions: rows of a session beyond ``max_rows`` go to further
salts, in contiguous ranges of their order (``operators.skew``), and its visit
is there once a salt. So no bucket holds more than ``max_rows`` rows of a session
and table, and joins on both columns give what the join on the session gives.
All sessions have a salt 0; others have nothing else.

A published state is as old as its last commit (``as_of``). It is made anew as a
whole, which is also its compaction: one file a bucket. It is shown by one row in
``by_session``, written last, so readers see the three tables of one state; the
state before it stays for those that are reading it.

Defined cases: tables without rows give buckets without files; a session without
visit keeps its events (their visit is NULL); several visits of a session (of
several loads or paths) must be consolidated or deduplicated first.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.operators import reports
from clickweave.operators.skew import split_hot_groups
from clickweave.session import staged
from clickweave.sinks.tables import COMMIT, CURATED_DB, LOAD_ID, PARTITION_COLUMNS

SALT = "salt"
KEYS = ["session_id", SALT]
#: Order of a session's rows, by which it is cut.
ORDER = {"events": ["timestamp", "event_unique_id"], "purchase_items": ["order_id", "item_index_in_order"]}
MAX_ROWS = 1_000_000
STATES = "by_session"
_STATES = T.StructType([
    T.StructField("state", T.StringType(), False),
    T.StructField("number", T.LongType(), False),
    T.StructField("as_of", T.LongType(), True, {"comment": "last commit that the state shows"}),
    T.StructField("buckets", T.IntegerType(), False),
])


def _name(database: str, table: str, state: str) -> str:
    return f"`{database}`.`{table}_by_session_{state}`"


def salted(tables: dict[str, DataFrame], max_rows: int = MAX_ROWS) -> dict[str, DataFrame]:
    """``visits``, ``events`` and ``purchase_items`` with ``salt``; a visit is there for each salt of its session."""
    out, parts = {}, []
    for name, order in ORDER.items():
        cut = split_hot_groups(tables[name], ["session_id"], max_rows, order, part_col=SALT)
        parts.append(cut.where("parts is not null").groupBy("session_id").agg(F.max("parts").alias("parts")))
        out[name] = cut.drop("parts").withColumn(SALT, F.coalesce(F.col(SALT), F.lit(0)).cast("int"))
    # a row a hot session: at most rows / max_rows
    most = staged(reduce(DataFrame.unionByName, parts).groupBy("session_id").agg(F.max("parts").cast("int").alias("parts")), "salts")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)
    out["visits"] = tables["visits"].join(most, "session_id", "left").withColumn(SALT, F.explode(salts)).drop("parts")
    return out


def _states(spark: SparkSession, database: str) -> DataFrame:
    return spark.table(f"`{database}`.`{STATES}`").orderBy(F.desc("number"))


def publish(
    spark: SparkSession,
    database: str = CURATED_DB,
    buckets: int | None = None,
    max_rows: int = MAX_ROWS,
    tables: dict[str, DataFrame] | None = None,
) -> str:
    """Lay out what the views of ``database`` show now (or ``tables``) by session; returns the name of the state.

    ``buckets`` is the number of tasks of later joins; without it, that of shuffle partitions.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _STATES.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{STATES}` ({fields}, `{COMMIT}` STRING) USING parquet PARTITIONED BY (`{COMMIT}`) COMMENT 'published states by session'")
    as_of = None
    if tables is None:
        # taken before the tables are read: the state has these commits at least
        as_of = spark.table(f"`{database}`.`loads`").agg(F.max("version")).first()[0]
        tables = {t: spark.table(f"`{database}`.`{t}`").drop(LOAD_ID, PARTITION_COLUMNS[t][0]) for t in ("visits", *ORDER)}
    state = uuid.uuid4().hex[:12]
    for name, df in salted({t: staged(df, f"publish-{t}") for t, df in tables.items()}, max_rows).items():
        # the same hash as that of buckets: a task writes one bucket, one file
        laid = df.repartition(buckets, *KEYS).write.format("parquet").bucketBy(buckets, *KEYS).sortBy(*KEYS)
        laid.saveAsTable(_name(database, name, state))
    last = _states(spark, database).first()
    row = spark.createDataFrame([(state, (last.number if last else 0) + 1, as_of, buckets)], _STATES)
    row.coalesce(1).withColumn(COMMIT, F.lit(state)).write.insertInto(f"`{database}`.`{STATES}`")
    return state


def read(spark: SparkSession, database: str = CURATED_DB) -> dict[str, DataFrame]:
    """The tables of the last published state, with ``salt``."""
    last = _states(spark, database).first()
    if last is None:
        raise ValueError(f"nothing of {database} is published by session")
    return {t: spark.table(_name(database, t, last.state)) for t in ("visits", *ORDER)}


def drop_old(spark: SparkSession, database: str = CURATED_DB, keep: int = 2) -> list[str]:
    """Drop all published states but the last ``keep``; returns their names."""
    if keep < 1:
        raise ValueError("the last state stays")
    old = [r.state for r in _states(spark, database).collect()[keep:]]  # a row a state
    for state in old:
        spark.sql(f"ALTER TABLE `{database}`.`{STATES}` DROP IF EXISTS PARTITION (`{COMMIT}`='{state}') PURGE")
        for t in ("visits", *ORDER):
            spark.sql(f"DROP TABLE IF EXISTS {_name(database, t, state)} PURGE")
    return old


def visits(spark: SparkSession, database: str = CURATED_DB) -> DataFrame:
    """The visits, one a session again."""
    return read(spark, database)["visits"].where(F.col(SALT) == 0).drop(SALT)


def events_with_visit(spark: SparkSession, database: str = CURATED_DB) -> DataFrame:
    """J1 on the published state."""
    t = read(spark, database)
    return reports.events_with_visit(t["events"], t["visits"], KEYS).drop(SALT)


def items_with_visit(spark: SparkSession, database: str = CURATED_DB) -> DataFrame:
    """J2 on the published state."""
    t = read(spark, database)
    return reports.items_with_visit(t["purchase_items"], t["visits"], KEYS).drop(SALT)


def sessions_with_purchase(spark: SparkSession, database: str = CURATED_DB) -> DataFrame:
    """J4 on the published state: a session with items has one in salt 0."""
    t = read(spark, database)
    first = t["visits"].where(F.col(SALT) == 0)
    return first.join(t["purchase_items"].select(*KEYS), KEYS, "left_semi").drop(SALT)
