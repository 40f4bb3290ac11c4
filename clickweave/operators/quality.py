"""Key checks, deduplication and path reconciliation.

The reference has no dedup, and its batch and live paths append to the
same tables, so one session can land twice (SURVEY §0). Every operator
here aggregates with a map-side partial step: a group of copies that
holds a large share of all rows is combined inside each input task before
the shuffle, so no task receives the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.operators import extract
from clickweave.operators.skew import many
from clickweave.schemas import PRIMARY_KEYS
from clickweave.session import COMPACT, staged


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key values that occur more than once, with their count."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def key_report(tables: dict[str, DataFrame], keys: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """A8 summary: rows, distinct keys and duplicated keys for each table."""
    keys = keys or PRIMARY_KEYS
    parts = []
    for name, df in tables.items():
        k = list(keys[name])
        per_key = df.groupBy(*k).agg(F.count(F.lit(1)).alias("n"))
        parts.append(
            per_key.agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"),
                F.count(F.lit(1)).cast("long").alias("key_count"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, 1)), F.lit(0)).cast("long").alias("duplicated_keys"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).cast("long").alias("extra_rows"),
            ).select(F.lit(name).alias("table_name"), "*")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, chosen deterministically (the smallest row).

    Copies are almost always equal rows: ``distinct``, a hash aggregate with
    a map-side step, removes them. Only keys that are left with several
    different rows are sorted for the smallest one, so a hot group of copies
    is reduced in its tasks and the result does not depend on input order or
    task retries.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    unique = df.distinct()
    if not rest:
        return unique.select(*df.columns)
    unique = staged(unique, "distinct", **COMPACT)
    several = staged(duplicate_keys(unique, keys).select(*keys), "several")
    if several.isEmpty():
        return unique.select(*df.columns)
    several = many(several)
    same = F.lit(True)
    for k in keys:
        same &= unique[k].eqNullSafe(several[k])
    clear = unique.join(several, same, "left_anti")
    least = unique.join(several, same, "left_semi").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return clear.select(*df.columns).unionByName(least.select(*keys, "_row.*").select(*df.columns))


def consolidate_visits(parts: DataFrame) -> DataFrame:
    """One visit row per session of visit parts, whatever the number of records, paths and loads.

    A session can be there several times: as copies of a record (through two
    paths, or a replay) and as parts of a long session. Copies are identical
    rows (deterministic extraction), part number included, so ``distinct``, a
    hash aggregate with a map-side step, removes them; only sessions that are
    left with several rows are merged, each of their parts once. A whole
    record stands for its session beside parts of it.
    """
    unique = staged(parts.distinct(), "distinct-parts", **COMPACT)
    several = many(staged(duplicate_keys(unique, ["session_id"]).select("session_id"), "several"))
    columns = [c for c in parts.columns if c not in ("part", "parts")]
    found = unique.join(several, "session_id", "left_semi")
    # the part number of a whole record is below all others, so one of them is kept alone
    whole = found.where("part is null").select("session_id").distinct().withColumn("has_whole", F.lit(True))
    found = found.join(many(staged(whole, "whole")), "session_id", "left").where("has_whole is null or part is null").withColumn("part", F.coalesce("part", F.lit(0)))
    merged = extract.merge_parts(found.select(*columns, "part"))
    return unique.join(several, "session_id", "left_anti").select(*columns).unionByName(merged.select(*columns))


def union_paths(*frames: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """U1 + R5: rows from several ingest paths, one per key.

    Columns missing in one path are NULL-filled (``allowMissingColumns``).
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return dedup(out, keys) if keys else out


def path_reconciliation(left: DataFrame, right: DataFrame, key: str = "session_id",
                        left_name: str = "batch", right_name: str = "live") -> DataFrame:
    """Keys present in only one of two paths, with the path that has them.

    One aggregate over both paths' keys, each with a flag of its path.
    """
    both = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r")))
    seen = both.groupBy(key).agg(F.max("l").alias("l"), F.max("r").alias("r")).where("l + r = 1")
    return seen.select(key, F.when(F.col("l") == 1, left_name).otherwise(right_name).alias("only_in"))


def profile_diff(batch_rows: DataFrame, live_rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows one profile produces and the other does not (multiset difference).

    Rows are counted with their profile's sign in one aggregate; what is left
    of a row is repeated as often as it is left.
    """
    cols = list(columns) if columns else [c for c in batch_rows.columns if c in live_rows.columns]
    both = batch_rows.select(*cols, F.lit(1).alias("_sign")).unionByName(live_rows.select(*cols, F.lit(-1).alias("_sign")))
    left = both.groupBy(*cols).agg(F.sum("_sign").alias("_n")).where("_n <> 0")
    only = F.when(F.col("_n") > 0, "batch").otherwise("live").alias("only_in")
    return left.select(*cols, only, F.explode(F.sequence(F.lit(1), F.abs("_n"))).alias("_i")).drop("_i")


def orphan_counts(children: dict[str, DataFrame], visits: DataFrame) -> DataFrame:
    """J3 summary: per child table, rows whose session has no visit.

    One aggregate by session over the keys of all tables, with a map-side
    step, so a hot session is a few rows when it is shuffled.
    """
    names = list(children)
    keys = visits.select("session_id", F.lit(True).alias("is_visit"), F.lit(None).cast("string").alias("table_name"))
    for name in names:
        keys = keys.unionByName(children[name].select("session_id", F.lit(False).alias("is_visit"), F.lit(name).alias("table_name")))
    per = keys.groupBy("session_id").agg(F.max("is_visit").alias("known"), *(F.count_if(F.col("table_name") == n).alias(f"n_{n}") for n in names))
    totals = per.agg(*(F.coalesce(F.sum(F.when(~F.col("known") | F.col("session_id").isNull(), F.col(f"n_{n}"))), F.lit(0)).alias(f"n_{n}") for n in names))
    rows = F.array(*(F.struct(F.lit(n).alias("table_name"), F.col(f"n_{n}").cast("long").alias("orphan_rows")) for n in names))
    return totals.select(F.explode(rows).alias("r")).select("r.*")
