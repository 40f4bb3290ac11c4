"""Mixing sources to target weights by temperature.

Method. Weights are source token shares raised to an exponent and normalised.
The exponent is bisected: to the smallest one whose busiest source repeats at
most ``repetition_limit`` times, or to the one whose weights have a target
entropy (nats). A source's part of the budget is then realised as whole
epochs, each a keyed permutation of its documents, and one partial epoch: the
permutation's documents as far as the tokens left reach. Permutations are cut
into blocks in which every source has its weight's part of ``block_tokens``.

Without a budget, the budget is the one that shows every document at least
once (the largest source gets one epoch), so nothing is dropped.

Scale. Only sums leave Spark: one aggregate over the written source table
narrows the exponent 32-fold. The place of a document in its permutation is a
prefix sum over buckets of the permutation key on two levels, so no window
holds a whole source. Which documents the partial epoch takes is one
threshold key per source, so texts are not moved: documents meet the small
source table (Catalyst broadcasts it by its written size; else both sides
shuffle and AQE splits a hot source).

Defined results: a null source is a source of its own; null or empty texts
have no tokens and go with every whole epoch; a source without tokens is
shown once; equal keys (repeated rows) are taken together, never beyond the
budget; a null doc_id has a key of its own; extra columns are kept by
``mix_documents`` and ignored by ``mix_order``; an empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import staged

WORD = r"[^\x20\x09-\x0D]+"
OWN = "__mix_"
#: Exponents that one aggregate tries, and aggregates: 32 ** -10 is below a double's precision.
FAN, PASSES = 32, 10
#: Rows that a bucket of the permutation should hold, and the most bits of its key used for buckets.
BUCKET_ROWS, BUCKET_BITS = 64, 20


def word_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def permutation_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Hex key that orders the documents of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")))


def find_exponent(sources: DataFrame, repetition_limit: float | None, entropy: float | None, budget: int | None) -> tuple[float, float]:
    """Exponent, and tokens of the budget, for ``sources(tokens)``."""
    if (repetition_limit is None) == (entropy is None):
        raise ValueError("give a repetition limit or a target entropy")
    some = sources.where("tokens > 0")
    low_high = some.agg(F.min("tokens"), F.max("tokens"), F.sum("tokens")).first()
    if low_high[0] is None:
        return 1.0, 0.0
    least, most, total = map(float, low_high)
    share = F.col("tokens") / total

    def passes(exponent: float, z: float, zlog: float) -> bool:
        if entropy is not None:
            return math.log(z) - exponent * zlog / z <= entropy
        shown = budget / total / z * (least / total) ** (exponent - 1) if budget else (least / most) ** (exponent - 1)
        return shown <= repetition_limit

    low, high = 0.0, 1.0 if entropy is None else 16.0
    for _ in range(PASSES):
        tries = [low + (high - low) * i / FAN for i in range(FAN + 1)]
        sums = some.agg(*(f for a in tries for f in (F.sum(F.pow(share, F.lit(a))), F.sum(F.pow(share, F.lit(a)) * F.log(share))))).first()
        good = [passes(a, sums[2 * i], sums[2 * i + 1]) for i, a in enumerate(tries)]
        if not good[-1]:
            raise ValueError("no exponent meets the target with this budget")
        at = good.index(True)
        if at == 0:
            high = tries[0]
            break
        low, high = tries[at - 1], tries[at]
    z = some.agg(F.sum(F.pow(share, F.lit(high)))).first()[0]
    return high, float(budget) if budget else most * z / (most / total) ** high


def _numbered(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds ``upto``: tokens of the source and epoch up to this key, equal keys included."""
    bits = max(0, min(BUCKET_BITS, math.ceil(math.log2(max(1, n_rows / BUCKET_ROWS)))))
    coarse, fine = bits - bits // 2, bits // 2
    number = F.conv(F.substring("key", 1, 5), 16, 10).cast("int")
    group = ["source", "epoch"]
    rows = rows.withColumn("coarse", F.shiftright(number, 20 - coarse)).withColumn("fine", F.shiftright(number, 20 - coarse - fine))
    by_fine = staged(rows.groupBy(*group, "coarse", "fine").agg(F.sum("tokens").alias("tokens")), "fine")
    before = lambda keys, order: F.coalesce(F.sum("tokens").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    by_coarse = by_fine.groupBy(*group, "coarse").agg(F.sum("tokens").alias("tokens"))
    by_coarse = by_coarse.withColumn("base", before(group, "coarse")).select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("coarse").alias("c"), "base")
    by_fine = by_fine.withColumn("inner", before([*group, "coarse"], "fine"))
    both = by_fine.join(by_coarse, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("coarse") == F.col("c")))
    both = both.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("coarse").alias("c"), F.col("fine").alias("f"), (F.col("base") + F.col("inner")).alias("base"))
    own = F.sum("tokens").over(Window.partitionBy(*group, "coarse", "fine").orderBy("key"))
    rows = rows.withColumn("own", own).join(both, F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("coarse") == F.col("c")) & (F.col("fine") == F.col("f")))
    return rows.withColumn("upto", F.col("own") + F.col("base")).drop("coarse", "fine", "own", "base", "s", "e", "c", "f")


class Mix:
    """The plan of a mix: ``sources`` (written) has weight, target, whole epochs and threshold of each source."""

    def __init__(self, docs: DataFrame, source: str = "source", tokens: Column | None = None, repetition_limit: float | None = None, entropy: float | None = None, budget: int | None = None, seed: int = 17) -> None:
        self.seed, self.source = seed, source
        tokens = word_tokens() if tokens is None else tokens
        self.sized = staged(docs.select("doc_id", F.col(source).alias("source"), tokens.alias("tokens")), "sized")
        shares = staged(self.sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")), "sources")
        self.exponent, self.budget = find_exponent(shares, repetition_limit, entropy, budget)
        total = shares.agg(F.sum("tokens"), F.sum("documents")).first()
        self.tokens, self.documents = total[0] or 0, total[1] or 0
        power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / float(self.tokens or 1), F.lit(self.exponent))).otherwise(0.0)
        z = shares.agg(F.sum(power)).first()[0] or 1.0
        target = F.floor(F.round(power / z * self.budget, 3)).cast("long")
        plan = shares.select("source", "tokens", (power / z).alias("weight"), target.alias("target"))
        whole = F.when(F.col("tokens") > 0, F.floor(F.col("target") / F.col("tokens"))).otherwise(1).cast("int")
        plan = plan.withColumn("epochs", whole)
        plan = plan.withColumn("rest", F.when(F.col("tokens") > 0, F.col("target") - F.col("epochs") * F.col("tokens")).otherwise(0))
        self.plan = staged(plan, "mix-plan")
        part = self._planned(self.sized).where("rest > 0").select("source", "doc_id", "tokens", F.col("epochs").alias("epoch"), "rest")
        part = part.withColumn("key", permutation_key(seed, F.col("epoch"), F.col("doc_id")))
        taken = _numbered(part, self.documents).where("upto <= rest").groupBy(F.col("source").alias("s")).agg(F.max("key").alias("threshold"))
        self.sources = staged(self.plan.join(taken, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "mix")

    def _planned(self, rows: DataFrame) -> DataFrame:
        plan = self.plan.select(F.col("source").alias("s"), "epochs", "rest", "weight")
        return rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def _shown(self, rows: DataFrame, doc_id: Column, source: Column) -> DataFrame:
        """One row per showing, with column ``OWN + epoch``."""
        plan = self.sources.select(F.col("source").alias(OWN + "source"), F.col("epochs").alias(OWN + "epochs"), F.col("threshold").alias(OWN + "threshold"))
        epochs = F.col(OWN + "epochs")
        partial = F.coalesce(permutation_key(self.seed, epochs, doc_id) <= F.col(OWN + "threshold"), F.lit(False))
        shows = epochs + partial.cast("int")
        rows = rows.join(plan, source.eqNullSafe(F.col(OWN + "source"))).withColumn(OWN + "shows", shows).where(F.col(OWN + "shows") > 0)
        return rows.withColumn(OWN + "epoch", F.explode(F.sequence(F.lit(0), F.col(OWN + "shows") - 1))).drop(OWN + "source", OWN + "epochs", OWN + "threshold", OWN + "shows")

    def documents_of(self, docs: DataFrame) -> DataFrame:
        """``docs`` as mixed: a row for each showing, with its columns."""
        return self._shown(docs, F.col("doc_id"), F.col(self.source)).select(*docs.columns)

    def order(self, block_tokens: int) -> DataFrame:
        """``doc_id, source, n_tokens, epoch, block`` of each showing; a block holds every source by its weight."""
        shown = self._shown(self.sized, F.col("doc_id"), F.col("source")).withColumnRenamed(OWN + "epoch", "epoch")
        shown = staged(shown.withColumn("key", permutation_key(self.seed, F.col("epoch"), F.col("doc_id"))), "shown")
        placed = _numbered(shown, self.documents).withColumnRenamed("tokens", "n_tokens")
        plan = self.plan.select(F.col("source").alias("s"), F.col("tokens").alias("all"), "weight")
        placed = placed.join(plan, F.col("source").eqNullSafe(F.col("s")))
        last = F.col("epoch") * F.col("all") + F.greatest(F.col("upto") - 1, F.lit(0))
        block = F.when(F.col("weight") > 0, F.floor(last / (F.col("weight") * block_tokens))).otherwise(0).cast("long")
        return placed.select("doc_id", "source", "n_tokens", "epoch", block.alias("block"))


def mix_order(docs: DataFrame, block_tokens: int = 1_000_000, **rules) -> DataFrame:
    return Mix(docs, **rules).order(block_tokens)


def mix_documents(docs: DataFrame, **rules) -> DataFrame:
    return Mix(docs, **rules).documents_of(docs)
