"""MinHash near-dedup by min-max hashing, with links confirmed on full shingle sets.

Method. Every permutation of the shingle hashes gives two signature values,
its minimum and its maximum, so half the permutations fill a signature. The
values are banded; documents that share a band meet in a bucket.

Plan, each step over written tables:

1. One pass over the texts gives set size, a 128-bit digest of the set and
   the bands. Equal sets collapse to a class named by its smallest doc_id.
2. Buckets of two or more classes: every member is compared with the
   bucket's smallest class on full sets (one comparison a member). Dense
   groups of copies fuse here, in linear work.
3. Buckets whose members still have different labels: members that the first
   step left apart are compared with the whole bucket, in blocks of at most
   ``BLOCK`` classes a side, one task row group per pair of blocks. A block
   returns a spanning forest of its links, never all pairs. No bucket is
   capped and no candidate dropped.
4. Components of all confirmed links are carried back over the classes.

Defined results: null or word-less text has an empty set and links with
nothing; rows that share a doc_id are one document, linked through any of its
texts; a null doc_id cannot be named by a link, so such a row is its own
component (null) and is kept; extra columns are ignored; an empty table gives
an empty result. Misses: a pair at the threshold shares no band with
probability below 1e-6: the number of bands of 5 values follows from the
threshold (24 at 85 percent, 35 at 80).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.graph import components
from clickweave.llm.joins import small_ids
from clickweave.llm.words import Powers, WordHashes, as_list_array, mix, shingles
from clickweave.session import staged

SHINGLE_WORDS = 5
BANDS, BAND_VALUES = 24, 5
#: Probability, at most, that a pair at the threshold shares no band.
MISS = 1e-6
#: Classes on each side of one block comparison.
BLOCK = 256
#: Shingles (columns) that one block comparison holds at a time.
SLAB = 4096


def bands_for(threshold: int, values: int = BAND_VALUES) -> int:
    """The least number of bands that miss a pair at ``threshold`` percent with a probability below ``MISS``."""
    share = (threshold / 100) ** values
    return 1 if share >= 1 else math.ceil(math.log(MISS) / math.log1p(-share))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(0, 2**32, n, np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, np.uint32)


def min_max_bands(x: np.ndarray, bands: int = BANDS, values: int = BAND_VALUES) -> np.ndarray:
    """Band keys of a set of 64-bit hashes: minima and maxima under each permutation, dealt to bands at random."""
    n = -(-bands * values // 2)
    a, b = _permutations(n)
    low, top = np.full(n, 2**32 - 1, np.uint32), np.zeros(n, np.uint32)
    short = (x >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(short), 2048):
        hashed = short[i : i + 2048, None] * a + b
        np.minimum(low, hashed.min(0), out=low)
        np.maximum(top, hashed.max(0), out=top)
    deal = np.random.default_rng(7).permutation(2 * n)[: bands * values]
    rows = np.concatenate([low, top])[deal].reshape(bands, values).astype(np.uint64)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in rows.T:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key


def _digest(x: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(x.tobytes())
    return [int(v) - (1 << 64) * (v >> 63) for v in (value >> 64, value & (1 << 64) - 1)]


def _signer(bands: int, values: int, k: int, with_set: bool):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, powers = WordHashes(), Powers()
        for batch in batches:
            sets = []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().lower().split()
                sets.append(shingles(words, hashes.of(words), k, powers))
            sizes = pa.array([len(x) for x in sets], pa.int64())
            if with_set:
                yield pa.record_batch([batch.column("doc_id"), sizes, as_list_array([x.view(np.int64) for x in sets], pa.int64())], names=["doc_id", "n_shingles", "shingles"])
                continue
            digests = [_digest(x) if len(x) else (None, None) for x in sets]
            keys = [min_max_bands(x, bands, values).view(np.int64) if len(x) else np.empty(0, np.int64) for x in sets]
            yield pa.record_batch(
                [batch.column("doc_id"), sizes, *(pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)), as_list_array(keys, pa.int64())],
                names=["doc_id", "n_shingles", "d0", "d1", "bands"],
            )

    return sign


def _found(threshold: int):
    """Spanning forest of the links between the U rows and all rows of a block pair."""

    def find(rows: pd.DataFrame) -> pd.DataFrame:
        at = np.flatnonzero(rows["part"].to_numpy() == 0), np.flatnonzero(rows["part"].to_numpy() == 1)
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        sets = [np.asarray(x, np.int64) for x in rows["shingles"]]
        sizes = np.array([len(x) for x in sets], np.int64)
        _, column, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), sizes)
        often = seen[column] > 1
        owner, column = owner[often], np.unique(column[often], return_inverse=True)[1]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((len(at[0]), len(at[1])), np.float32)
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, SLAB):
            a, b = np.searchsorted(column, [first, first + SLAB])
            slab = np.zeros((len(sets), SLAB), np.float32)
            slab[owner[a:b], column[a:b] - first] = 1
            common += slab[at[0]] @ slab[at[1]].T
        common = common.astype(np.int64)
        union = sizes[at[0]][:, None] + sizes[at[1]][None, :] - common
        linked = (100 * common >= threshold * union) & (labels[at[0]][:, None] != labels[at[1]][None, :])
        root: dict = {}

        def top(x):
            while root.get(x, x) != x:
                root[x] = x = root.get(root[x], root[x])
            return x

        out = []
        for i, j in np.argwhere(linked):
            x, y = at[0][i], at[1][j]
            p, q = top(labels[x]), top(labels[y])
            if p != q:
                root[max(p, q)] = min(p, q)
                out.append((ids[x], ids[y]))
        return pd.DataFrame(out, columns=["a", "b"])

    return find


def confirmed_links(docs: DataFrame, members: DataFrame, threshold: int, k: int = SHINGLE_WORDS) -> DataFrame:
    """Links ``(a, b)`` that span every group of ``members(key, pivot, id)`` linked at ``threshold`` percent."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    ids = staged(members.select("id").union(members.select("pivot")).distinct().withColumnRenamed("id", "doc_id"), "candidates")
    texts = docs.select("doc_id", "text").join(small_ids(ids), "doc_id", "left_semi")
    sets = staged(texts.mapInArrow(_signer(0, 0, k, True), f"doc_id {id_type}, n_shingles long, shingles array<long>"), "sets")

    def side(name: str) -> DataFrame:
        return sets.select(*(F.col(c).alias(f"{name}_{c}") for c in sets.columns))

    common = F.size(F.array_intersect("a_shingles", "b_shingles"))
    star = (
        members.select(F.col("pivot").alias("a"), F.col("id").alias("b"))
        .distinct()
        .join(side("b"), F.col("b") == F.col("b_doc_id"))
        .join(side("a"), F.col("a") == F.col("a_doc_id"))
        .where(F.lit(100) * F.least("a_n_shingles", "b_n_shingles") >= F.lit(threshold) * F.greatest("a_n_shingles", "b_n_shingles"))
        .withColumn("common", common)
        .where(F.lit(100) * F.col("common") >= F.lit(threshold) * (F.col("a_n_shingles") + F.col("b_n_shingles") - F.col("common")))
        .select("a", "b")
    )
    star = staged(star, "star")
    labels = components(star)

    named = members.join(labels, "id", "left").select("key", "pivot", "id", F.coalesce("label", "id").alias("label"))
    pivots = labels.select(F.col("id").alias("pivot"), F.col("label").alias("pivot_label"))
    named = staged(named.join(pivots, "pivot", "left").withColumn("pivot_label", F.coalesce("pivot_label", "pivot")), "named")
    apart = F.col("label") != F.col("pivot_label")
    buckets = (
        named.groupBy("key")
        .agg(F.count("*").alias("n"), F.sum(apart.cast("long")).alias("n_apart"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("print"), F.min("pivot").alias("pivot"), F.min("pivot_label").alias("pivot_label"))
        .where("n_apart > 0 and n > 1")
    )
    # the same members often meet in several bands: once is enough
    once = buckets.groupBy("print", "n", "n_apart", "pivot").agg(F.min("key").alias("key"), F.min("pivot_label").alias("pivot_label"))
    once = staged(once.select("key", "pivot", "pivot_label", F.ceil((F.col("n") + 1) / BLOCK).cast("int").alias("all_blocks"), F.ceil(F.col("n_apart") / BLOCK).cast("int").alias("apart_blocks")), "apart")
    rest = named.select("key", "id", "label").join(once, "key")
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")
    block = F.floor(own * F.col("blocks") / (1 << 20)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rest.where(apart).withColumn("blocks", F.col("apart_blocks")).select("key", block.alias("u"), across("all_blocks").alias("t"), "id", "label", F.lit(0).alias("part"))
    whole = rest.select("key", "id", "label", "all_blocks", "apart_blocks").unionByName(once.select("key", F.col("pivot").alias("id"), F.col("pivot_label").alias("label"), "all_blocks", "apart_blocks"))
    right = whole.withColumn("blocks", F.col("all_blocks")).select("key", across("apart_blocks").alias("u"), block.alias("t"), "id", "label", F.lit(1).alias("part"))
    blocks = left.unionByName(right).join(sets.withColumnRenamed("doc_id", "id"), "id")
    more = blocks.groupBy("key", "u", "t").applyInPandas(_found(threshold), f"a {id_type}, b {id_type}")
    return star.unionByName(staged(more, "more"))


def near_duplicates(docs: DataFrame, threshold: int = 80, k: int = SHINGLE_WORDS, bands: int | None = None, band_values: int = BAND_VALUES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; links at 100 * common >= threshold * union."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    bands = bands or bands_for(threshold, band_values)
    signed = staged(docs.mapInArrow(_signer(bands, band_values, k, False), f"doc_id {id_type}, n_shingles long, d0 long, d1 long, bands array<long>"), "signed")
    classes = staged(signed.where("d0 is not null and doc_id is not null").groupBy("d0", "d1").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = signed.join(classes.select("d0", "d1", F.col("rep").alias("doc_id")), ["doc_id", "d0", "d1"])
    exploded = staged(reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key")), "bands")
    shared = exploded.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).where("pivot < last")
    members = staged(exploded.join(staged(shared.select("key", "pivot"), "shared"), "key").where("id <> pivot"), "members")
    links = confirmed_links(docs, members, threshold, k)
    # a doc_id whose rows lie in several classes, or beside an empty text in one, links them
    digest = F.struct("d0", "d1")
    several = signed.where("doc_id is not null").groupBy("doc_id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).where("not low <=> high")
    lying = signed.select("doc_id", "d0", "d1").join(small_ids(staged(several.select("doc_id"), "several")), "doc_id", "left_semi").distinct()
    lying = staged(lying.join(classes, ["d0", "d1"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b")), "lying")
    labels = components(links.unionByName(lying))
    named = staged(classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("d0", "d1", F.coalesce("label", "rep").alias("component")), "components")
    own = lying.select(F.col("b").alias("id")).distinct().join(labels, "id").select(F.col("id").alias("doc_id"), F.col("label").alias("reached"))
    whole = signed.drop("bands").join(named, ["d0", "d1"], "left").join(staged(own, "own"), "doc_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "component", "doc_id"))
    return whole.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_near_duplicates(docs: DataFrame, **rules) -> DataFrame:
    """The row of smallest doc_id of each component, with the columns of ``docs``.

    Of several rows with that doc_id the one of least hash stays; rows
    without a doc_id all stay. The rows that go are far fewer than those that
    stay, so they are the side that texts are joined with.
    """
    verdicts = staged(near_duplicates(docs, **rules).where("doc_id is not null").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("copies")), "verdicts")
    own = "__near_id"
    several = verdicts.where("kept and copies > 1").select(F.col("doc_id").alias(own))
    gone = staged(verdicts.where("not kept or copies > 1").select(F.col("doc_id").alias(own)), "gone")
    rows = docs.join(small_ids(gone), F.col("doc_id") == F.col(own), "left_anti")
    if not several.isEmpty():
        whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
        one = docs.join(several, F.col("doc_id") == F.col(own)).groupBy(own).agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("__near_row"))
        rows = rows.unionByName(one.select("__near_row.*"))
    return rows
