"""Table sinks, commits and provisioning.

Tables live in a Spark catalog database. Two databases model the governance
zones: ``raw`` (landed text, one row per input line) and ``curated`` (the
flat tables). Both are written by loads in the same way; ``plans.curate``
derives the one from the other.

A table of a zone is a view over its rows. Rows are Parquet,
partitioned by a date, so date filters prune files, and by ``attempt``, one
try of a load to write its tables. A load commits by one row in ``loads``,
written after all its tables: the views show the rows of the last committed
attempt of each load and of nothing else. So a load that fails between two
tables is seen nowhere, a load that is written again (a retry, a replay)
replaces its own rows in all tables at once, and nothing is dropped before its
replacement is there. ``truncate`` and ``replace_days`` are commits too: they
hide what was committed before them, all of it or the days they have rows of.
``vacuum`` deletes rows that no view shows any more.

Visits are written as parts: a row per session record, with its number where
the record is a part of a long session. Parts merge by minimum, maximum and
sum after copies of a part are taken once, in any order and from any load; the
view ``visits`` merges them on read. Whole records, nearly all, pass through.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.operators import history
from clickweave.schemas import JOB_RUNS, PAGE_VIEW_ALERTS, PRIMARY_KEYS, TABLES, VISIT_PARTS, ddl
from clickweave.session import staged

RAW_DB = "raw"
CURATED_DB = "curated"

# Date column derived at write time, per loaded table: (name, source column;
# none: the day of the load).
PARTITION_COLUMNS = {
    "visits": ("visit_date", "start_timestamp"),
    "events": ("event_date", "timestamp"),
    "purchase_items": ("order_date", "purchase_event_timestamp"),
    "rejects": ("landed_date", None),
    "page_views": ("window_date", "window_end"),
    "page_view_alerts": ("window_date", "window_end"),
    "files": ("loaded_date", None),
    "derivations": ("derived_date", None),
    "sessions_raw": ("landed_date", None),
}
#: Tables whose day follows from the key: an event's id is made of its time.
DAY_OF_KEY = ("events",)
RAW_SESSIONS = "sessions_raw"
RAW_TABLES = (RAW_SESSIONS,)
CURATED_TABLES = tuple(t for t in PARTITION_COLUMNS if t not in RAW_TABLES)
#: ``attempt`` says where rows lie, ``origin`` which attempt made them; the two differ in compacted rows only.
LOAD_ID, ATTEMPT, ORIGIN, COMMIT = "load_id", "attempt", "origin", "commit_id"
#: Partitions that one statement of ``vacuum`` drops.
PARTITIONS_A_DROP = 500

# How a load meets what is there: beside it, instead of all of it, or instead
# of the days that it has rows of.
APPEND, TRUNCATE, REPLACE_DAYS = "append", "truncate", "replace_days"
MODES = (APPEND, TRUNCATE, REPLACE_DAYS)

TABLE_COMMENTS = {
    "visits": "one row per session",
    "events": "flattened session events",
    "purchase_items": "one row per purchased item",
    "page_views": "page views per tumbling window of publish time",
    "page_view_alerts": "windows above the page-view threshold",
    "rejects": "input rows that failed a check, with the reason",
    "job_runs": "completion notices of runs",
    "loads": "committed loads",
    "files": "input files that committed loads have read",
    "derivations": "landings of the raw zone that have been decoded, with the version of the decoder",
    "sessions_raw": "raw session lines as received",
}

# Tag-like table properties (R4: zone and tags on curated tables).
TABLE_TAGS = {"zone": "curated", "domain": "clickstream"}

LOADS = T.StructType([
    T.StructField("load_id", T.StringType(), False),
    T.StructField("attempt", T.StringType(), False),
    T.StructField("mode", T.StringType(), False),
    T.StructField("version", T.LongType(), False, {"comment": "order of commits"}),
    T.StructField("as_of", T.LongType(), True, {"comment": "last commit that replaced days hide"}),
    T.StructField("days", T.ArrayType(T.StructType([T.StructField("table_name", T.StringType()), T.StructField("day", T.DateType())]))),
    T.StructField("metrics", T.MapType(T.StringType(), T.LongType())),
])


def _qualified(db: str, name: str) -> str:
    return f"`{db}`.`{name}`"


def _rows_table(name: str) -> str:
    return f"{name}_rows"


def _schema(name: str) -> T.StructType:
    return {"visits": VISIT_PARTS, "page_view_alerts": PAGE_VIEW_ALERTS}.get(name) or TABLES[name]


def provision(spark: SparkSession, database: str = CURATED_DB, location: str | None = None, names: Sequence[str] = CURATED_TABLES) -> list[str]:
    """Create the database and its tables (``names``, and those of loads and runs) if they do not exist.

    Idempotent: an existing table is left as it is. Returns the table names
    that exist afterwards.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` COMMENT 'clickstream {database} zone'{loc}")
    props = ", ".join(f"'{k}'='{v}'" for k, v in {**TABLE_TAGS, "zone": database}.items())

    def table(name: str, schema: T.StructType, comment: str, more: str = "", part: str = "") -> None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_qualified(database, name)} ({ddl(schema)}{more}) USING parquet{part} COMMENT '{comment}' TBLPROPERTIES ({props})")

    table("job_runs", JOB_RUNS, TABLE_COMMENTS["job_runs"])
    # a partition a commit: sessions that know the table find new ones in the catalog
    table("loads", LOADS, TABLE_COMMENTS["loads"], f", `{COMMIT}` STRING", f" PARTITIONED BY (`{COMMIT}`)")
    for name in names:
        day = PARTITION_COLUMNS[name][0]
        part = f" PARTITIONED BY (`{day}`, `{ATTEMPT}`)"
        table(_rows_table(name), _schema(name), f"rows of {name}, committed or not", f", `{ORIGIN}` STRING, `{day}` DATE, `{ATTEMPT}` STRING", part)
        if not spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"CREATE VIEW IF NOT EXISTS {_qualified(database, name)} COMMENT '{TABLE_COMMENTS[name]}' TBLPROPERTIES ({props}) AS {_view(database, name)}")
    return [*names, "job_runs", "loads"]


def _loads(database: str) -> str:
    """SQL: ``loads`` at its real size, for joins.

    Of a partitioned table without statistics Catalyst takes the size as
    unbounded, and every join with it shuffles the rows by their attempt, a key
    of a few values: one task would get all rows of a load. A filter of the
    partitions has their files listed, and their size known.
    """
    return f"(SELECT * FROM {_qualified(database, 'loads')} WHERE `{COMMIT}` IS NOT NULL)"


def _committed(database: str) -> str:
    """SQL: the last attempt of each load that no later truncation hides (one narrow row a load)."""
    loads = _loads(database)
    return f"""
SELECT {LOAD_ID}, {ATTEMPT}, version FROM (
  SELECT *, row_number() OVER (PARTITION BY {LOAD_ID} ORDER BY version DESC, {ATTEMPT} DESC) AS nth FROM {loads}
) WHERE nth = 1 AND version >= coalesce((SELECT max(version) FROM {loads} WHERE mode = '{TRUNCATE}'), 0)"""


def _shown(database: str, name: str, columns: str | None = None) -> str:
    """SQL: the committed rows of a table, with their ``load_id``."""
    day, loads = PARTITION_COLUMNS[name][0], _loads(database)
    columns = columns or ", ".join([*(f"r.`{f.name}`" for f in _schema(name).fields), f"r.`{day}`", f"l.{LOAD_ID}"])
    return f"""
SELECT {columns}
FROM {_qualified(database, _rows_table(name))} r
JOIN ({_committed(database)}) l ON r.{ORIGIN} = l.{ATTEMPT}
JOIN (SELECT {ATTEMPT}, max(version) AS version FROM {loads} GROUP BY {ATTEMPT}) p ON r.{ATTEMPT} = p.{ATTEMPT}
LEFT JOIN (
  SELECT d.day, max(as_of) AS as_of FROM {loads} LATERAL VIEW explode(days) e AS d
  WHERE d.table_name = '{name}' GROUP BY d.day
) h ON r.`{day}` <=> h.day
WHERE h.as_of IS NULL OR p.version > h.as_of"""


def _view(database: str, name: str) -> str:
    if name != "visits":
        return _shown(database, name)
    plain = [f.name for f in TABLES["visits"].fields]
    rest = [c for c in plain if c not in ("session_id", "start_timestamp", "end_timestamp", "event_count")]
    copies = ", ".join(f"min({c}) AS {c}" for c in (*rest, "start_timestamp", "end_timestamp", "event_count"))
    merged = ", ".join(f"min({c}) AS {c}" for c in (*rest, "start_timestamp"))
    return f"""
WITH shown AS ({_shown(database, name)}),
parts AS (
  SELECT session_id, part, {copies}, max({LOAD_ID}) AS {LOAD_ID} FROM shown WHERE part IS NOT NULL GROUP BY session_id, part
), merged AS (
  SELECT session_id, {merged}, max(end_timestamp) AS end_timestamp, sum(event_count) AS event_count, max({LOAD_ID}) AS {LOAD_ID}
  FROM parts GROUP BY session_id
)
SELECT {", ".join(plain)}, visit_date, {LOAD_ID} FROM shown WHERE part IS NULL
UNION ALL
SELECT {", ".join(plain)}, to_date(start_timestamp) AS visit_date, {LOAD_ID} FROM merged"""


def read_parts(spark: SparkSession, database: str) -> DataFrame:
    """The committed visit parts, not merged (``schemas.VISIT_PARTS`` and ``load_id``)."""
    return spark.sql(_shown(database, "visits"))


def read_load(spark: SparkSession, name: str, database: str, load_id: str) -> DataFrame:
    """The rows that a load wrote."""
    return spark.table(_qualified(database, name)).where(F.col(LOAD_ID) == load_id)


def _day(name: str) -> Column:
    source = PARTITION_COLUMNS[name][1]
    return F.to_date(F.col(source)) if source else F.current_date()


def new_attempt(load_id: str) -> str:
    if not load_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a load id has letters, digits, - and _ only, got {load_id!r}")
    return f"{load_id}.{uuid.uuid4().hex[:12]}"


def write_attempt(df: DataFrame, name: str, database: str, attempt: str) -> dict[str, int]:
    """Write the rows of one table under an attempt; nobody sees them before ``commit``.

    Returns what was counted while the rows were written (A10): no scan follows.
    """
    day, target = PARTITION_COLUMNS[name][0], _qualified(database, _rows_table(name))
    seen = {f"{name}_rows": F.count(F.lit(1))}
    if name == "rejects":
        seen["record_rejects"] = F.count_if(F.col("stage") == "record")
    if name == "visits":  # a session has one record that is whole or its first part
        seen["visits_rows"] = F.count_if(F.coalesce(F.col("part"), F.lit(0)) == 0)
    observed = Observation()
    if day not in df.columns:
        df = df.withColumn(day, _day(name))
    if ORIGIN not in df.columns:
        df = df.withColumn(ORIGIN, F.lit(attempt))
    df = df.withColumn(ATTEMPT, F.lit(attempt)).observe(observed, *(c.cast("long").alias(k) for k, c in seen.items()))
    columns = [*(f.name for f in _schema(name).fields), ORIGIN, day, ATTEMPT]
    df.select(*columns).write.insertInto(target)
    counted = observed.get
    return {k: int(counted.get(k) or 0) for k in seen}


def _last_version(spark: SparkSession, database: str) -> int:
    return spark.table(_qualified(database, "loads")).agg(F.max("version")).first()[0] or 0


def commit(spark: SparkSession, database: str, load_id: str, attempt: str, mode: str = APPEND, tables: tuple[str, ...] = (), metrics: dict[str, int] | None = None, as_of: int | None = None, days: list[tuple] | None = None, also: DataFrame | None = None) -> None:
    """One row in ``loads``: from here on the views show the attempt's rows, in all tables at once.

    ``also`` names further loads (``load_id``, ``origin``) whose rows the attempt
    wrote; their rows in ``loads`` are in the same file, so all are committed or none.

    For ``replace_days`` the row names ``days``, those that the attempt has rows
    of; views hide what was committed up to ``as_of`` (all until now) of them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if mode == REPLACE_DAYS and days is None:
        found = [
            spark.table(_qualified(database, _rows_table(t))).where(F.col(ATTEMPT) == attempt).select(F.lit(t).alias("table_name"), F.col(PARTITION_COLUMNS[t][0]).alias("day")).distinct()
            for t in tables
        ]
        days = [(r.table_name, r.day) for r in reduce(DataFrame.unionByName, found).collect()]  # a row a day
    last = _last_version(spark, database)
    if mode == REPLACE_DAYS and as_of is None:
        as_of = last
    row = (load_id, attempt, mode, max(last + 1, time.time_ns() // 1000), as_of, days, metrics)
    rows = spark.createDataFrame([row], LOADS)
    if also is not None:
        values = {LOAD_ID: F.col(LOAD_ID), ATTEMPT: F.col(ORIGIN), "mode": F.lit(mode), "version": F.lit(row[3])}
        rows = rows.unionByName(also.select(*(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LOADS.fields)))
    rows.coalesce(1).withColumn(COMMIT, F.lit(attempt)).write.insertInto(_qualified(database, "loads"))


def write_load(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    database: str = CURATED_DB,
    load_id: str | None = None,
    mode: str = APPEND,
    after_table: Callable[[str], None] | None = None,
    counted: dict[str, int] | None = None,
) -> dict[str, int]:
    """Write several tables as one load, and commit it last.

    ``append`` adds the rows, in place of an earlier attempt of the same
    ``load_id``. ``truncate`` and ``replace_days`` also hide all earlier rows,
    or those of the days that a table has rows of. ``after_table`` is called
    with the name of each table once it is written. Returns the metrics, those
    that are ``counted`` already among them.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    load_id = load_id or uuid.uuid4().hex
    attempt, metrics = new_attempt(load_id), dict(counted or {})
    for name, df in tables.items():
        metrics |= write_attempt(df, name, database, attempt)
        if after_table:
            after_table(name)
    commit(spark, database, load_id, attempt, mode, tuple(tables), metrics)
    return metrics


def without_known(spark: SparkSession, tables: dict[str, DataFrame], database: str, load_id: str) -> dict[str, DataFrame]:
    """The tables of a load without rows that other committed loads have, and each key once.

    Visits are compared as parts. Tables without a key (``rejects``) stay as they
    are. What ``load_id`` itself wrote before is no history, so a load that is
    written again replaces its rows by the same. Loads that commit meanwhile
    are not seen.
    """
    out = dict(tables)
    for name in tables.keys() & {"visits", "events", "purchase_items"}:
        keys, day = list(PRIMARY_KEYS[name]), PARTITION_COLUMNS[name][0]
        before = read_parts(spark, database) if name == "visits" else spark.table(_qualified(database, name))
        if name == "visits":
            keys.append("part")
        load = tables[name] if day in tables[name].columns else tables[name].withColumn(day, _day(name))
        out[name] = history.new_rows(load, before.where(F.col(LOAD_ID) != load_id), keys, day if name in DAY_OF_KEY else None)
    return out


def write_table(df: DataFrame, name: str, database: str = CURATED_DB, mode: str = APPEND, load_id: str | None = None) -> None:
    """K1: one table as a load of its own; a table that is not loaded (``job_runs``) is appended to."""
    if name in PARTITION_COLUMNS:
        write_load(df.sparkSession, {name: df}, database, load_id, mode)
    else:
        target = _qualified(database, name)
        df.select(*df.sparkSession.table(target).columns).write.insertInto(target)


def compact(spark: SparkSession, name: str, database: str, before: str) -> list[_dt.date | None]:
    """Gather the rows of each day before ``before`` that lie in several places into one (live loads are many and small).

    Days that lie in one place are left alone. Rows keep the load they are
    of, so a load that is written again replaces them still. What is
    gathered stands in for what was committed when it was read; what is
    committed meanwhile stays beside it. Parts of visits stay parts. Returns the days.
    """
    day = PARTITION_COLUMNS[name][0]
    as_of = _last_version(spark, database)
    columns = ", ".join([*(f"r.`{f.name}`" for f in _schema(name).fields), f"r.`{day}`", f"r.{ORIGIN}", f"r.{ATTEMPT}", "p.version"])
    rows = spark.sql(_shown(database, name, columns)).where((F.col(day) < F.lit(before).cast("date")) & (F.col("version") <= as_of))
    days = [r[0] for r in rows.groupBy(day).agg(F.count_distinct(ATTEMPT).alias("places")).where("places > 1").collect()]  # a row a day
    if days:
        load_id = f"compacted-{name}-{as_of}"
        attempt = new_attempt(load_id)
        # a task a day; AQE splits large ones
        write_attempt(rows.where(F.col(day).isin(days)).drop("version", ATTEMPT).hint("rebalance", day), name, database, attempt)
        commit(spark, database, load_id, attempt, REPLACE_DAYS, (name,), as_of=as_of, days=[(name, d) for d in days])
    return days


def vacuum(spark: SparkSession, database: str, older_than_hours: float = 24.0) -> int:
    """Drop the partitions that no view shows.

    Those of attempts that wrote, or of loads that committed, within the last
    ``older_than_hours`` stay: the load may not have committed yet, a reader
    may still be at what a commit has hidden. Then ``loads`` is gathered in one
    file. What comes to the driver is a row a partition. Returns the number of
    partitions dropped.
    """
    limit = time.time_ns() // 1000 - int(older_than_hours * 3.6e9)
    young = spark.table(_qualified(database, "loads")).where(F.col("version") > limit).select(ATTEMPT)
    dropped = 0
    for name, (day, _) in PARTITION_COLUMNS.items():
        if not spark.catalog.tableExists(f"{database}.{_rows_table(name)}"):
            continue
        target = _qualified(database, _rows_table(name))
        shown = spark.sql(_shown(database, name, f"r.`{day}` AS shown_day, r.{ATTEMPT} AS shown_attempt")).distinct()
        there = spark.table(target).groupBy(day, ATTEMPT).agg(F.max(F.unix_micros("_metadata.file_modification_time")).alias("written"))
        gone = there.where(F.col("written") <= limit).join(young, ATTEMPT, "left_anti")
        gone = gone.join(shown, F.col(day).eqNullSafe(F.col("shown_day")) & (F.col(ATTEMPT) == F.col("shown_attempt")), "left_anti")
        specs = [f"PARTITION (`{day}`=" + ("NULL" if d is None else f"'{d}'") + f", `{ATTEMPT}`='{a}')" for d, a in gone.select(day, ATTEMPT).collect()]
        _drop(spark, target, specs)
        dropped += len(specs)
    gather_loads(spark, database)
    return dropped


def gather_loads(spark: SparkSession, database: str) -> None:
    """Gather the commits in one partition of ``loads``.

    The copy is there before the originals go; a row that is there twice
    counts once, so a failure between leaves the same loads.
    """
    target = _qualified(database, "loads")
    table = spark.table(target)
    old = [r[0] for r in table.select(COMMIT).distinct().collect()]  # a row a load at most
    if len(old) < 2:
        return
    rows = staged(table.drop(COMMIT).dropDuplicates([LOAD_ID, ATTEMPT]), "loads")
    rows.coalesce(1).withColumn(COMMIT, F.lit(f"gathered-{uuid.uuid4().hex[:12]}")).write.insertInto(target)
    _drop(spark, target, [f"PARTITION (`{COMMIT}`='{x}')" for x in old])


def _drop(spark: SparkSession, target: str, specs: list[str]) -> None:
    for i in range(0, len(specs), PARTITIONS_A_DROP):
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS {', '.join(specs[i : i + PARTITIONS_A_DROP])} PURGE")


def land_raw(lines: DataFrame, database: str = RAW_DB, load_id: str | None = None) -> dict[str, int]:
    """R4 raw zone: append the input lines untouched, with source and landing time, as one load.

    The raw table keeps every line, including the ones the curated tables
    reject, so any curated row can be traced back and derived again
    (``plans.curate``). A landing that is written again replaces its lines.
    """
    provision(lines.sparkSession, database, names=RAW_TABLES)
    src = F.col("source") if "source" in lines.columns else F.lit(None).cast("string")
    out = lines.select("value", src.alias("source"), F.current_timestamp().alias("landed_at"))
    return write_load(lines.sparkSession, {RAW_SESSIONS: out}, database, load_id)


def landings(spark: SparkSession, database: str = RAW_DB) -> DataFrame:
    """The committed landings of the raw zone: ``landing, landing_attempt, version``, the latter the order of commits."""
    landed = spark.table(_qualified(database, "loads")).where(f"metrics['{RAW_SESSIONS}_rows'] is not null").select(ATTEMPT).distinct()
    shown = spark.sql(_committed(database)).join(landed, ATTEMPT, "left_semi")
    return shown.select(F.col(LOAD_ID).alias("landing"), F.col(ATTEMPT).alias("landing_attempt"), "version")


def landed_lines(spark: SparkSession, since: int, attempts: Sequence[str], database: str = RAW_DB) -> DataFrame:
    """``value, source, landing_attempt`` of the lines that lie where ``attempts`` wrote them, or where a compaction after version ``since`` put them.

    Only these partitions are read.
    """
    gathered = spark.table(_qualified(database, "loads")).where((F.col("mode") == REPLACE_DAYS) & (F.col("version") > since))
    places = [*attempts, *(r[0] for r in gathered.select(ATTEMPT).distinct().collect())]  # a row a compaction
    rows = spark.sql(_shown(database, RAW_SESSIONS, f"r.value, r.source, r.{ORIGIN} AS landing_attempt, r.{ATTEMPT} AS place"))
    return rows.where(F.col("place").isin(places)).drop("place")


def job_run_row(
    spark: SparkSession,
    job_name: str,
    status: str,
    source: str | None,
    destination: str | None,
    metrics: dict[str, int],
    run_id: str | None = None,
) -> DataFrame:
    """K7: the completion notice as a one-row frame (source bucket/object, destination, job name)."""
    row = (
        job_name,
        run_id or uuid.uuid4().hex,
        _dt.datetime.now(_dt.timezone.utc),
        status,
        source,
        destination,
        {k: int(v) for k, v in metrics.items()},
    )
    return spark.createDataFrame([row], JOB_RUNS)


def record_job_run(spark: SparkSession, database: str = CURATED_DB, **kw) -> None:
    """K7: append the completion notice to ``job_runs``."""
    write_table(job_run_row(spark, **kw), "job_runs", database)
