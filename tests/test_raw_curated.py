"""Raw zone -> curated tables: what is derived when, and what is read for it."""

import pytest
from pyspark.sql import functions as F

from clickweave.plans.curate import derivation_state, derive, high_water_mark, with_decoder_version
from clickweave.sinks import tables as sinks
from clickweave.sources.decode import parse_sessions
from tests.conftest import ev, lines_df, session


def land(spark, raw, load_id, *sids, more=()):
    return sinks.land_raw(lines_df(spark, [session(s, [ev()]) for s in sids] + list(more)), raw, load_id)


def sessions(spark, database):
    return sorted((r.session_id, r.decoder_version) for r in with_decoder_version(spark, "visits", database).collect())


def versions(spark, raw):
    return {r.landing: r.version for r in sinks.landings(spark, raw).collect()}


def loads(spark, database):
    return spark.table(f"{database}.loads").count()


def test_landings_are_derived_once(spark):
    raw, database = "raw_once", "cur_once"
    assert derive(spark, database, raw) == {} and loads(spark, database) == 0  # nothing landed yet
    land(spark, raw, "a", "S1", "S2", more=["", None, "{broken"])
    got = derive(spark, database, raw)
    assert got["derivations_rows"] == 1 and got["visits_rows"] == 2 and got["record_rejects"] == 3
    assert derive(spark, database, raw) == {} and loads(spark, database) == 2  # the run and its landing
    land(spark, raw, "b", "S3")
    sinks.land_raw(lines_df(spark, [session("S0")]).limit(0), raw, "empty")
    assert high_water_mark(spark, 1, database, raw) == versions(spark, raw)["a"]
    assert derive(spark, database, raw)["derivations_rows"] == 2
    assert high_water_mark(spark, 1, database, raw) == max(versions(spark, raw).values())
    assert high_water_mark(spark, 2, database, raw) is None
    assert sessions(spark, database) == [("S1", 1), ("S2", 1), ("S3", 1)]
    runs = spark.table(f"{database}.job_runs").where("job_name = 'derive'").collect()
    assert sorted(r.metrics["visits_rows"] for r in runs) == [1, 2]


def test_a_landing_that_is_written_again_is_derived_again(spark):
    raw, database = "raw_again", "cur_again"
    land(spark, raw, "a", "S1", "S2")
    land(spark, raw, "b", "S3")
    derive(spark, database, raw)
    land(spark, raw, "a", "S2", "S4")
    assert spark.table(f"{raw}.sessions_raw").count() == 3
    assert [r.landing for r in derivation_state(spark, database, raw).where("decoder_version is null").collect()] == ["a"]
    assert derive(spark, database, raw)["derivations_rows"] == 1
    assert sessions(spark, database) == [("S2", 1), ("S3", 1), ("S4", 1)]


def test_versions_of_the_decoder(spark):
    raw, database = "raw_versions", "cur_versions"
    land(spark, raw, "a", more=["[broken"])
    land(spark, raw, "b", "S1")
    sinks.provision(spark, database)
    loaded = parse_sessions(lines_df(spark, [session("S9", [ev()])]))
    from clickweave.operators import extract
    sinks.write_load(spark, extract.tables(loaded), database, "other")
    derive(spark, database, raw)
    good = F.when(F.col("value") == "[broken", '{"session_id":"S0"}').otherwise(F.col("value"))

    def mended(lines):
        return parse_sessions(lines.withColumn("value", good))

    with pytest.raises(OSError):
        def lose(name):
            if name == "rejects":
                raise OSError("lost")
        derive(spark, database, raw, mended, 2, after_table=lose)
    assert sessions(spark, database) == [("S1", 1), ("S9", None)] and spark.table(f"{database}.rejects").count() == 1
    assert derive(spark, database, raw, mended, 2)["derivations_rows"] == 2
    assert derive(spark, database, raw) == {}
    assert sessions(spark, database) == [("S0", 2), ("S1", 2), ("S9", None)] and spark.table(f"{database}.rejects").count() == 0
    # what no view shows goes, what is shown stays
    assert sinks.vacuum(spark, database, 0) > 0
    assert sessions(spark, database) == [("S0", 2), ("S1", 2), ("S9", None)]
    # rows that a truncation hides are derived again
    sinks.write_load(spark, extract.tables(loaded), database, "other", sinks.TRUNCATE)
    assert sessions(spark, database) == [("S9", None)]
    assert derive(spark, database, raw, mended, 2)["derivations_rows"] == 2
    assert sessions(spark, database) == [("S0", 2), ("S1", 2), ("S9", None)]


def test_only_pending_partitions_are_read(spark):
    raw = "raw_pruned"
    for name in ("a", "b", "c"):
        land(spark, raw, name, f"S-{name}")
    at = {r.landing: (r.landing_attempt, r.version) for r in sinks.landings(spark, raw).collect()}

    def read(*names):
        df = sinks.landed_lines(spark, min(at[n][1] for n in names), [at[n][0] for n in names], raw)
        files = [f for f in df.inputFiles() if "/sessions_raw_rows/" in f]
        return sorted(r.landing_attempt.split(".")[0] for r in df.collect()), {f.split("attempt=")[1].split(".")[0] for f in files}

    assert read("b") == (["b"], {"b"}) and read("a", "c") == (["a", "c"], {"a", "c"})
    # compacted lines are found where they lie now
    sinks.compact(spark, "sessions_raw", raw, "2999-01-01")
    assert read("b")[0] == ["a", "b", "c"] and sorted(at) == sorted(r.landing for r in sinks.landings(spark, raw).collect())
    assert derive(spark, "cur_pruned", raw)["visits_rows"] == 3
    land(spark, raw, "d", "S-d")
    at |= {r.landing: (r.landing_attempt, r.version) for r in sinks.landings(spark, raw).collect()}
    assert read("d") == (["d"], {"d"})
