"""Deduplication of a load against its history (R5/U1): answers, the filter, and what is read."""

import re

from pyspark.sql import functions as F

from clickweave.operators import history, quality
from clickweave.session import staged

KEYS = ["k", "part"]
SCHEMA = "k string, part long, day date, v long"


def frame(spark, n, step=1, offset=0):
    i = F.col("id") * step + offset
    return spark.range(n).select(
        F.when(i % 50 != 7, F.concat(F.lit("key-"), i.cast("string"))).alias("k"), F.when(i % 3 == 0, i % 5).alias("part"),
        F.when(i % 11 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (i % 40).cast("int"))).alias("day"), i.alias("v"),
    )


def both(spark):
    load = frame(spark, 300, 7, 500)
    load = load.unionByName(load.withColumn("v", F.col("v") + 1)).unionByName(load)  # copies, and other rows of the same keys
    return load, staged(quality.dedup(frame(spark, 2000), KEYS), "history")


def rows(df):
    return sorted(map(str, df.collect()))


def test_new_rows_equal_full_dedup(spark):
    load, before = both(spark)
    got = rows(before.unionByName(history.new_rows(load, before, KEYS)))
    # everything deduplicated, rows of the history first
    ranked = before.withColumn("at", F.lit(0)).unionByName(load.withColumn("at", F.lit(1)))
    full = ranked.groupBy(*KEYS).agg(F.min(F.struct("at", "day", "v")).alias("r")).select(*KEYS, "r.day", "r.v")
    assert got == rows(full) and len(got) > before.count()
    # null keys are keys
    assert history.new_rows(load, before, KEYS).where("k is null").count() == 0 < load.where("k is null").count()
    # the answer does not depend on the filter
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert history.threshold_bytes(load) == -1
        assert rows(before.unionByName(history.new_rows(load, before, KEYS))) == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_days_of_the_load_only(spark):
    load, before = both(spark)
    all_days = rows(history.new_rows(load, before, KEYS))
    assert rows(history.new_rows(load, before, KEYS, "day")) == all_days  # the day follows from the key here
    late = load.withColumn("day", F.date_add("day", 1)).where("day > '2024-01-20' and k is not null")  # the day of a NULL key does not follow
    assert rows(history.new_rows(late, before, KEYS, "day", slack_days=1)) == rows(history.new_rows(late, before, KEYS))


def test_empty_sides(spark):
    load, before = both(spark)
    none = spark.createDataFrame([], SCHEMA)
    assert rows(history.new_rows(none, before, KEYS, "day")) == [] == rows(history.known_keys(none, before, KEYS, "day"))
    assert rows(history.new_rows(load, none, KEYS, "day")) == rows(quality.dedup(load, KEYS))


def test_filter_keeps_every_match_and_few_others(spark):
    load, before = staged(frame(spark, 2000), "load"), frame(spark, 60000)
    kept = staged(history.may_hold(before, load, KEYS), "kept")
    match = before.join(load.select(*KEYS).distinct().withColumnsRenamed({"k": "k2", "part": "p2"}), F.col("k").eqNullSafe(F.col("k2")) & F.col("part").eqNullSafe(F.col("p2")), "left_semi")
    assert rows(match.exceptAll(kept)) == []
    others = kept.count() - match.count()
    assert others < 0.05 * (before.count() - match.count()), others


def test_what_is_read_and_shuffled(spark, tmp_path):
    """Partitions of other days and columns beside the key are not read; the filter is in the scan's stage, before the shuffle."""
    path = str(tmp_path / "history")
    frame(spark, 5000).withColumn("day", F.coalesce("day", F.lit("2024-01-01").cast("date"))).write.partitionBy("day").parquet(path)
    before = spark.read.parquet(path)
    load = staged(before.where("day in ('2024-01-03', '2024-01-09')").orderBy(F.desc("day")).limit(200), "load")
    plan = history.known_keys(load, before, KEYS, "day")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if re.search(r"FileScan.*PartitionFilters: \[.*day#\d+ IN \(2024-01-03,2024-01-09\)", line))
    assert "FileScan parquet [k#" in scan and "v#" not in scan.split("Batched")[0]
    above = plan[: plan.index(scan)].splitlines()
    steps = [x.strip(" :+-").split("(")[0].split(" ")[0] for x in above]
    first = {s: len(steps) - 1 - steps[::-1].index(s) for s in ("BroadcastHashJoin", "HashAggregate", "Exchange")}
    # nearest to the scan is the filter, then the partial aggregate, then the only shuffle
    assert first["BroadcastHashJoin"] > first["HashAggregate"] > first["Exchange"] and steps.count("Exchange") == 1, plan


def test_a_hot_key_is_found_once(spark):
    """A third of the history is one key that the load has; it is found once."""
    hot = frame(spark, 3000).unionByName(spark.range(1500).select(F.lit("key-1").alias("k"), F.lit(None).cast("long").alias("part"), F.lit("2024-01-02").cast("date").alias("day"), F.col("id").alias("v")))
    load = staged(frame(spark, 2), "load")
    found = history.known_keys(load, staged(hot, "history"), KEYS)
    assert sorted(r.k for r in found.collect()) == ["key-0", "key-1"]


def test_rows_without_ties_are_written_once(spark):
    """Copies alone leave one row a key, which needs no join and no second copy."""
    copies = frame(spark, 300).where("k is not null").unionByName(frame(spark, 300).where("k is not null"))
    once = quality.dedup(copies, KEYS)
    assert "Join" not in once._jdf.queryExecution().optimizedPlan().toString()
    assert once.count() == copies.distinct().count() == copies.count() // 2
    assert all(f.endswith(".zstd.parquet") for f in once.inputFiles())
    new = history.new_rows(copies, once.limit(0), KEYS)
    assert any("/distinct-" in f for f in new.inputFiles()) and new.count() == once.count()
