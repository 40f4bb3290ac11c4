"""Document fingerprints by consistent weighted sampling.

Method. A text is a weighted set: its word pairs (a lone word by itself) by
count. For each of ``SAMPLES`` positions every term draws r, c ~ Gamma(2, 1)
and b ~ U(0, 1) from its hash; with t = floor(ln w / r + b) the term's value
is ln c - r * (t - b) - r, and the term of least value is sampled with its t.
Two texts agree in a position with a probability equal to the generalised
Jaccard similarity of their weighted sets. A fingerprint is the samples,
hashed to 16 bits each, in hex; likeness is the share of equal positions.

Plan of ``neighbour_fingerprints`` (each text against its successor by
doc_id): the ids alone are cut into ranges by approximate quantiles; each text
is dealt once to its range, sorted there, and read as a stream, so a task
holds two texts at a time. The first text of each range also goes to the end
of the range before (of the last range, for the first), which gives every last
text its successor. Only cuts and first ids (a few per shuffle partition) come
to the driver.

Defined results: null and empty texts, and texts of white space, have no term
and the empty fingerprint; two of those have likeness 1, and one of them and
any other 0. Equal doc_ids follow each other by text; null doc_ids come first;
a lone row is its own successor; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.words import Powers, WordHashes, window_hashes

SAMPLES = 64
#: Bits of a draw: quantiles of a Gamma(2, 1) variable that the tables hold.
BITS = 16
#: Ranges of ids for each shuffle partition.
RANGES = 4


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quantiles of a Gamma(2, 1) variable, their logarithms, and odd multipliers for the draws."""
    u = (np.arange(1 << BITS) + 0.5) / (1 << BITS)
    low, high = np.zeros(len(u)), np.full(len(u), 64.0)
    for _ in range(60):  # the root of 1 - exp(-x) * (1 + x) = u, by bisection
        middle = (low + high) / 2
        less = -np.expm1(-middle) - middle * np.exp(-middle) < u
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    gamma = (low + high) / 2
    odd = np.random.default_rng(31).integers(0, 2**31, (2, SAMPLES), np.uint32) * np.uint32(2) + np.uint32(1)
    return gamma.astype(np.float32), np.log(gamma).astype(np.float32), odd


def samples(terms: np.ndarray, weights: np.ndarray, tables: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """16-bit samples of a weighted set of distinct 64-bit terms."""
    gamma, log_gamma, odd = tables
    least = np.full(SAMPLES, np.inf, np.float32)
    taken = np.zeros(SAMPLES, np.uint64)
    at = np.arange(SAMPLES)
    halves = (terms >> np.uint64(32)).astype(np.uint32), terms.astype(np.uint32)
    low = np.uint32((1 << BITS) - 1)
    for i in range(0, len(terms), 512):
        part, weight = terms[i : i + 512], weights[i : i + 512]
        first, second = (h[i : i + 512, None] * o for h, o in zip(halves, odd, strict=True))
        r = gamma.take((first >> np.uint32(BITS)).view(np.int32), mode="clip")
        value = log_gamma.take((second >> np.uint32(BITS)).view(np.int32), mode="clip")
        # 1 - b, uniform as b is
        rest = (first & low).view(np.int32).astype(np.float32)
        rest *= np.float32(1 / (1 << BITS))
        many = np.flatnonzero(weight > 1)
        if len(many):
            t = np.floor(np.log(weight[many], dtype=np.float32)[:, None] / r[many] + 1 - rest[many])
        rest *= r
        value -= rest  # of weight 1, where t is 0
        if len(many):
            value[many] -= r[many] * t
        pick = value.argmin(0)
        found = value[pick, at]
        chosen = part[pick]
        if len(many):
            place = np.full(len(part), -1)
            place[many] = np.arange(len(many))
            step = np.where(place[pick] >= 0, t[place[pick], at], 0).astype(np.int64)
            chosen = chosen + step.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        lower = found < least
        least[lower] = found[lower]
        taken[lower] = chosen[lower]
    mixed = (taken ^ (taken >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.uint16)


class Fingerprinter:
    def __init__(self) -> None:
        self._hashes, self._powers, self._tables = WordHashes(), Powers(), _tables()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").split()
        if not words:
            return np.empty(0, np.uint16)
        terms, weights = np.unique(window_hashes(self._hashes.of(words), min(2, len(words)), self._powers), return_counts=True)
        return samples(terms, weights, self._tables)


def as_text(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal positions, the estimate of the generalised Jaccard similarity."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Fingerprinter()
        for batch in batches:
            prints = [as_text(of(x.as_py() or "")) for x in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(made, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint string")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (home, ahead, doc_id): each own row against the row after it."""
    of = Fingerprinter()
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    before, rows = None, []
    for batch in batches:
        for home, ahead, doc_id, text in zip(*(batch.column(c) for c in ("home", "ahead", "doc_id", "text")), strict=True):
            home, ahead, text = home.as_py(), ahead.as_py(), text.as_py() or ""
            if ahead and before is None:
                continue  # a further row of the first id of the next range
            own = of(text)
            if before is not None:
                old_id, old, old_print = before
                cut = len(old) // 4
                edited = old[: len(old) - cut] + text[:cut]
                edited_print = of(edited) if cut else old_print
                rows.append((old_id, len(old), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), as_text(old_print), as_text(edited_print), likeness(old_print, edited_print), likeness(old_print, own)))
            before = None if ahead else (doc_id.as_py(), text, own)
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows = []


def neighbour_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness (see the contract of the query)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions * RANGES
    cuts = docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)) if n > 1 else []
    edges = np.unique(np.array(cuts, float))

    none = -(2**63)  # stands for a null id, which comes before all others
    known = F.coalesce("doc_id", F.lit(none))

    def home_of(ids: pd.Series) -> np.ndarray:
        return np.where(ids == none, 0, np.searchsorted(edges, ids.astype(float), "right"))

    home = F.pandas_udf(lambda ids: pd.Series(home_of(ids)), "int")
    firsts = docs.select(known.alias("id")).withColumn("home", home("id")).groupBy("home").agg(F.min("id").alias("first")).orderBy("home").collect()
    homes = [r["home"] for r in firsts]
    before = dict(zip([r["first"] for r in firsts], [*homes[-1:], *homes[:-1]], strict=True))

    @F.pandas_udf("array<struct<home int, ahead boolean>>")
    def homes_of(ids: pd.Series) -> pd.Series:
        own = home_of(ids)
        return pd.Series([[(int(h), False)] + ([(before[k], True)] if k in before else []) for h, k in zip(own, ids, strict=True)])

    dealt = docs.withColumn("at", F.explode(homes_of(known))).select(F.col("at.home").alias("home"), F.col("at.ahead").alias("ahead"), "doc_id", "text")
    ordered = dealt.repartition(partitions, "home").sortWithinPartitions("home", "ahead", "doc_id", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return ordered.mapInArrow(_pairs, schema)
