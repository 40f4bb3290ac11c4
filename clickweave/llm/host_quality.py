"""Quality rules with host-level verdicts, in DataFrame functions only.

Rules of a text (base rules): fewer than ``min_words`` words, or more than
``max_repeat`` percent of the words inside three-word windows that occur
twice or more in the text. Hosts: the rate of base failures of each host (the
``source`` column) is shrunk towards all hosts by a beta prior whose mean and
weight are the moments of the host rates; a host whose shrunk rate exceeds
``max_host_rate`` rejects all its documents.

Plan: one pass over the texts writes the narrow measures; hosts are summed
with partial aggregates from that table, and their verdicts, a written table,
are joined back (broadcast by Catalyst when their real size is small, else a
sort-merge join of two written tables, which AQE splits for a hot host).
Windows of one text are sorted inside its row; no text is exploded or moved.

Defined results: a null or empty text has no words and fails the base rules;
a null host is a host of its own; repeated rows count once each; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.session import staged

SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Working columns carry this prefix, so that no column of the input clashes.
OWN = "__quality_"


def _col(name: str) -> Column:
    return F.col(OWN + name)


def with_measures(docs: DataFrame, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """Adds the measures of ``text`` and ``base_failed``, under the prefix ``OWN``.

    Each step is a projection of its own: what a lambda reads must be a
    column, or it would be computed anew for every element.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(_col("words")) - 3),
        lambda i: F.struct(F.xxhash64(F.get(_col("words"), i), F.get(_col("words"), i + 1), F.get(_col("words"), i + 2)).alias("h"), i.alias("i")),
    )
    again = lambda x, k: F.coalesce(F.get(_col("sorted"), k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(_col("sorted"), k + 1)["h"] == x["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(_col("sorted"), again), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(i - s["last"], F.lit(3))).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    measured = (
        docs.withColumn(OWN + "text", F.coalesce("text", F.lit("")))
        .withColumn(OWN + "words", F.filter(F.split(_col("text"), SPACE), lambda w: w != ""))
        .withColumn(OWN + "lines", F.filter(F.split(_col("text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn(OWN + "sorted", F.when(F.size(_col("words")) > 2, F.array_sort(windows)))
        .withColumns(
            {
                OWN + "n_words": F.size(_col("words")).cast("long"),
                OWN + "word_chars": F.char_length(F.array_join(_col("words"), "")).cast("long"),
                OWN + "n_symbols": F.regexp_count(_col("text"), F.lit("[#*$%&|<>]")).cast("long"),
                OWN + "n_dup_lines": (F.size(_col("lines")) - F.size(F.array_distinct(_col("lines")))).cast("long"),
                OWN + "n_repeat_words": F.coalesce(covered, F.lit(0).cast("long")),
            }
        )
        .drop(OWN + "text", OWN + "words", OWN + "lines", OWN + "sorted")
    )
    failed = (_col("n_words") < min_words) | (100 * _col("n_repeat_words") > max_repeat * _col("n_words"))
    return measured.withColumn(OWN + "base_failed", failed)


def host_rates(measured: DataFrame, host: str = "source") -> DataFrame:
    """``host, n, failures, rate``: the failure rate of each host after empirical beta shrinkage.

    Prior mean: failures of all rows. Prior weight ``mean * (1 - mean) /
    variance - 1`` from the spread of the host rates, at least 1; without
    spread the weight is the number of rows, so every host has the mean.
    """
    hosts = measured.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(_col("base_failed").cast("long")).alias("failures"))
    hosts = staged(hosts, "hosts")
    rate = F.col("failures") / F.col("n")
    prior = hosts.agg(F.sum("failures") / F.sum("n"), F.var_samp(rate), F.sum("n")).first()  # one row
    mean, spread, rows = (x or 0 for x in prior)
    weight = float(max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else rows)
    shrunk = (F.col("failures") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return hosts.select("host", "n", "failures", shrunk.alias("rate"))


def judged(docs: DataFrame, host: str = "source", min_words: int = 50, max_repeat: int = 50, max_host_rate: float = 0.5, with_text: bool = True) -> DataFrame:
    """``docs`` with measures, ``base_failed`` and ``kept`` under the prefix ``OWN``, from a written table."""
    measured = with_measures(docs, min_words, max_repeat)
    measured = staged(measured if with_text else measured.drop("text"), "quality")
    bad = staged(host_rates(measured, host).where(F.col("rate") > max_host_rate).select(F.col("host").alias(OWN + "host"), F.lit(True).alias(OWN + "bad_host")), "bad-hosts")
    out = measured.join(bad, F.col(host).eqNullSafe(F.col(OWN + "host")), "left")
    return out.withColumn(OWN + "kept", ~_col("base_failed") & _col("bad_host").isNull()).drop(OWN + "host", OWN + "bad_host")


def quality_verdicts(docs: DataFrame, **rules) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of every row."""
    rows = judged(docs.select("doc_id", "text", rules.get("host", "source")), with_text=False, **rules)
    return rows.select("doc_id", *(F.col(OWN + c).alias(c) for c in (*MEASURES, "base_failed", "kept")))


def clean_documents(docs: DataFrame, **rules) -> DataFrame:
    """The kept rows of ``docs``, with its columns."""
    return judged(docs, **rules).where(_col("kept")).select(*docs.columns)
