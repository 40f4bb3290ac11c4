"""Raw zone -> curated tables (R4): what was landed is decoded once per version of the decoder.

    raw.sessions_raw --(landings not derived yet)--> decoder --> {visits, events, purchase_items, rejects} + derivations

A landing is a load of the raw zone. What has been derived of it is a load of
the curated zone that bears its name, so deriving it again replaces its rows in
all tables at once, and rows of other loads stay. The ledger ``derivations`` is
a table of the same loads: it says, with the commit that shows the rows, which
attempt of a landing was decoded and by which version of the decoder. What is to
do is the difference of two small tables, a row a landing; a landing that
commits late, or is written again, is found as well, which a single time as
high-water mark would miss. All landings of a run are decoded by one job and
committed together.

Defined cases: nothing to do commits nothing; a landing without lines is
derived and has no rows; a lower version than that of a landing leaves it alone;
runs at the same time derive the same rows, of which one commit is shown; curated
rows that a truncation hides are derived again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators import extract
from clickweave.session import ensure_checkpoint_dir, staged
from clickweave.sinks import tables as sinks
from clickweave.sources.decode import parse_sessions

DERIVED = "derived-"


def derivation_state(spark: SparkSession, database: str = sinks.CURATED_DB, raw_database: str = sinks.RAW_DB) -> DataFrame:
    """Each landing with the version of the decoder its curated rows are of (NULL: not derived as it is now)."""
    derived = spark.table(f"`{database}`.`derivations`").groupBy("landing", "landing_attempt").agg(F.max("decoder_version").alias("decoder_version"))
    return sinks.landings(spark, raw_database).join(derived, ["landing", "landing_attempt"], "left")


def high_water_mark(spark: SparkSession, version: int, database: str = sinks.CURATED_DB, raw_database: str = sinks.RAW_DB) -> int | None:
    """The last landing (its version in the raw zone) up to which everything is derived by ``version`` or a later one; NULL: none."""
    behind = F.coalesce(F.col("decoder_version") < version, F.lit(True))
    state = derivation_state(spark, database, raw_database).agg(F.min(F.when(behind, F.col("version"))).alias("first"), F.collect_list("version").alias("all"))
    below = F.filter("all", lambda v: F.coalesce(v < F.col("first"), F.lit(True)))
    return state.select(F.array_max(below)).first()[0]


def decoder_versions(spark: SparkSession, database: str = sinks.CURATED_DB) -> DataFrame:
    """Written table ``load_id, decoder_version``: a row a landing that is derived."""
    derived = spark.table(f"`{database}`.`derivations`")
    return staged(derived.groupBy(sinks.LOAD_ID).agg(F.max("decoder_version").alias("decoder_version")), "decoder-versions")


def with_decoder_version(spark: SparkSession, name: str, database: str = sinks.CURATED_DB, versions: DataFrame | None = None) -> DataFrame:
    """A curated table with the ``decoder_version`` that each row is of (NULL: not derived from the raw zone).

    ``versions`` is what ``decoder_versions`` gave, for several tables of one state.
    """
    versions = decoder_versions(spark, database) if versions is None else versions
    return spark.table(f"`{database}`.`{name}`").join(versions, sinks.LOAD_ID, "left")


def derive(
    spark: SparkSession,
    database: str = sinks.CURATED_DB,
    raw_database: str = sinks.RAW_DB,
    decoder: Callable[[DataFrame], DataFrame] = parse_sessions,
    version: int = 1,
    profile: str = extract.BATCH,
    after_table: Callable[[str], None] | None = None,
) -> dict[str, int]:
    """Decode the landings that ``version`` of the decoder has not decoded, and commit them together.

    ``decoder`` takes lines (``value``, ``source`` and columns it keeps) and
    returns records as ``sources.decode.parse_sessions`` does. Only partitions
    that hold lines of these landings are read. Returns the metrics;
    ``derivations_rows`` is the number of landings.
    """
    sinks.provision(spark, database)
    sinks.provision(spark, raw_database, names=sinks.RAW_TABLES)
    run = f"derive-{uuid.uuid4().hex}"
    attempt = sinks.new_attempt(run)
    state = derivation_state(spark, database, raw_database).where(F.coalesce(F.col("decoder_version") < version, F.lit(True)))
    load = F.concat(F.lit(DERIVED), F.col("landing"))
    todo = staged(state.select(
        "landing", "landing_attempt", "version", F.lit(version).cast("long").alias("decoder_version"), load.alias(sinks.LOAD_ID),
        F.concat(load, F.lit("." + attempt.rsplit(".", 1)[1])).alias(sinks.ORIGIN),
    ), "to-derive")
    landed = todo.select("landing_attempt", "version").collect()  # a row a landing, as are the partitions they name
    if not landed:
        return {}
    lines = sinks.landed_lines(spark, min(r.version for r in landed), [r.landing_attempt for r in landed], raw_database)
    ensure_checkpoint_dir(spark)
    parsed = decoder(lines.join(todo.select("landing_attempt", sinks.ORIGIN), "landing_attempt").drop("landing_attempt")).checkpoint(eager=True)
    metrics = {}
    for name, df in (extract.tables(parsed, profile, keep=[sinks.ORIGIN]) | {"derivations": todo}).items():
        metrics |= sinks.write_attempt(df, name, database, attempt)
        if after_table:
            after_table(name)
    sinks.commit(spark, database, run, attempt, metrics=metrics, also=todo)
    sinks.record_job_run(spark, database, job_name="derive", status="SUCCEEDED", source=raw_database, destination=database, metrics=metrics, run_id=run)
    return metrics
