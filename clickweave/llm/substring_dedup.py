"""Substring dedup by level-wise doubling of repeated word windows.

Method. A window that repeats at a length can only consist of windows that
repeat at half of it. Windows of half the asked length are looked up first,
and only where they repeat are they extended to twice their length; the
doubling goes on (``repeat_levels``) until no candidate survives, or, to
remove repeats of a given length, ends at that length: a longer repeat covers
the words that its windows of that length cover.

The first level needs no window at every place: of the half windows inside a
window, the one of least hash is the same wherever the window occurs. Only
these are gathered (about one in thirteen), which loses no repeat. A window
is known by the hashes of its two halves, 128 bits.

Plan: (1) one pass over the texts writes word counts, a digest of the words
and the least half windows; texts with the same words fall to the smallest
doc_id of their class, and only that one goes on. (2) Half windows that occur
in two documents: a partial aggregate per hash, joined back to name the
candidate documents. (3) Candidate texts are read once more and give their
candidate windows of full length; a partial aggregate finds the smallest
document of each, and a join back (two written tables, so AQE splits the
windows that very many documents share) the places to remove. No list per
window is ever built; what is gathered by document is bounded by its text.

Defined results: a null or empty text has no words; a window counts once per
document; a document with a null doc_id is smaller than none, and neither
removes nor loses words by itself; equal rows lose the same words; rows with
one doc_id and different texts are one document and lose words each by its own
text; a text shorter than a window is kept; extra columns are kept by
``without_repeats``; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.joins import only, small_ids
from clickweave.llm.words import Powers, WordHashes, as_list_array, window_hashes
from clickweave.session import staged

WINDOW = 50
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def sliding_least(x: np.ndarray, span: int) -> np.ndarray:
    """Least of each ``span`` neighbours, by doubling."""
    width = 1
    while 2 * width <= span:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = span - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _half(window: int) -> int:
    return -(-window // 2)


class _Windows:
    """Half windows of a text, and for each whole window its least half window."""

    def __init__(self, window: int) -> None:
        self.window, self.half = window, _half(window)
        self._hashes, self._powers = WordHashes(), Powers()

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(words) < self.window:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        halves = window_hashes(self._hashes.of(words), self.half, self._powers)
        return halves, sliding_least(halves, self.window - self.half + 1)


def _signer(window: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(window)
        for batch in batches:
            rows, least = [], []
            for text in batch.column("text"):
                words = (text.as_py() or "").encode().split()
                joined = b" ".join(words)
                digest = xxhash.xxh3_128_intdigest(joined)
                rows.append((len(words), digest >> 64, digest & (1 << 64) - 1, hashlib.sha256(joined).hexdigest()))
                least.append(np.unique(windows(words)[1]).view(np.int64))
            n, d0, d1, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
            signed = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (d0, d1)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("row"), pa.array(n, pa.int64()), *signed, pa.array(sha, pa.string()), as_list_array(least, pa.int64())],
                names=["doc_id", "row", "n_words", "d0", "d1", "sha256", "halves"],
            )

    return sign


def _extender(window: int):
    """Windows of full length whose least half window repeats."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _Windows(window)
        for batch in batches:
            for doc_id, row, text, halves in zip(*(batch.column(c) for c in ("doc_id", "row", "text", "halves")), strict=True):
                hashes, least = windows(text.as_py().encode().split())
                places = np.flatnonzero(np.isin(least, halves.values.to_numpy().view(np.uint64)))
                if len(places):
                    n = len(places)
                    keys = [pa.array(hashes[places + k].view(np.int64)) for k in (0, window - _half(window))]
                    yield pa.record_batch([pa.repeat(doc_id, n), pa.repeat(row, n), pa.array(places.astype(np.int32)), *keys], names=["doc_id", "row", "place", "k0", "k1"])

    return extend


def repeated(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Written table of the ``keys`` that occur in two documents or more, with the ``first`` of them."""
    found = windows.groupBy(*keys).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    return staged(found.where("first < last").drop("last"), "repeated")


def _signed(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Written table of what each row's words are, and the classes of equal words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("row"))
    schema = f"doc_id {id_type}, row long, n_words long, d0 long, d1 long, sha256 string, halves array<long>"
    signed = staged(rows.mapInArrow(_signer(window), schema), "signed")
    classes = signed.where(F.col("n_words") >= window).groupBy("d0", "d1").agg(F.min("doc_id").alias("least_id"))
    return signed, staged(classes, "classes")


def candidates(docs: DataFrame, signed: DataFrame, classes: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Written tables: candidate texts, and their windows of full length that may repeat."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chosen = signed.join(classes.withColumnRenamed("least_id", "doc_id"), ["d0", "d1", "doc_id"])
    halves = staged(chosen.select("doc_id", F.explode("halves").alias("half")), "halves")
    again = halves.join(repeated(halves, ["half"]).select("half"), "half").groupBy("doc_id").agg(F.collect_set("half").alias("halves"))
    again = staged(again, "candidates")
    texts = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("row"))
    texts = staged(only(texts, again.select("doc_id"), "doc_id").join(again, "doc_id"), "candidate-texts")
    windows = texts.mapInArrow(_extender(window), f"doc_id {id_type}, row long, place int, k0 long, k1 long")
    return texts, staged(windows, "windows")


def _remover(window: int):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(batch.column("text"), batch.column("places"), strict=True):
                raw = text.as_py().encode()
                bounds = np.array([m.span() for m in _WORD.finditer(raw)], np.int64).reshape(-1, 2)
                starts = places.values.to_numpy()
                edge = np.zeros(len(bounds) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + window, -1)
                gone = np.cumsum(edge)[:-1] > 0
                # runs of removed words: cut from the first of them to the next word that stays
                change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                kept, at = [], 0
                for i, j in change.reshape(-1, 2):
                    kept.append(raw[at : bounds[i, 0]])
                    at = bounds[j, 0] if j < len(bounds) else len(raw)
                kept.append(raw[at:])
                clean = b"".join(kept)
                digest = hashlib.sha256(b" ".join(clean.split())).hexdigest()
                rows.append((clean.decode(), int(gone.sum()), digest))
            clean, n, sha = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.record_batch([batch.column("doc_id"), batch.column("row"), pa.array(clean, pa.string()), pa.array(n, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "row", "text", "n_removed", "sha256"])

    return remove


def _changes(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Signed rows, and a written ``doc_id, row, text, n_removed, sha256`` of those that lose words."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed, classes = _signed(docs, window)
    texts, windows = candidates(docs, signed, classes, window)
    seen = windows.join(repeated(windows, ["k0", "k1"]), ["k0", "k1"]).where("first < doc_id")
    places = staged(seen.groupBy("doc_id", "row").agg(F.collect_list("place").alias("places")), "places")
    cut = texts.select("doc_id", "row", "text").join(places, ["doc_id", "row"])
    cut = cut.mapInArrow(_remover(window), f"doc_id {id_type}, row long, text string, n_removed long, sha256 string")
    # all words of a later document of a class start windows of its first one
    later = signed.join(classes, ["d0", "d1"]).where("doc_id > least_id")
    later = later.select("doc_id", "row", F.lit("").alias("text"), F.col("n_words").alias("n_removed"), F.sha2(F.lit("").cast("binary"), 256).alias("sha256"))
    return signed, staged(cut.unionByName(later).dropDuplicates(["doc_id", "row"]), "changes")


def repeat_verdicts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row (the hash is over kept words joined by a space)."""
    signed, changes = _changes(docs.select("doc_id", "text"), window)
    found = changes.select("doc_id", "row", "n_removed", F.col("sha256").alias("kept"))
    rows = signed.select("doc_id", "row", "n_words", "sha256").join(found, ["doc_id", "row"], "left")
    return rows.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "sha256").alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words cut from ``text``; ``n_chars``, where it is a column, follows.

    Only rows that lose words are joined with their new texts; all others are
    joined with the ids of those, a narrow table.
    """
    _, changes = _changes(docs.select("doc_id", "text"), window)
    own = "__substring_"
    found = changes.select(F.col("doc_id").alias(own + "id"), F.col("row").alias(own + "row"), F.col("text").alias(own + "text"))
    match = (F.col("doc_id") == F.col(own + "id")) & (F.xxhash64("text") == F.col(own + "row"))
    ids = staged(found.drop(own + "text"), "changed")
    same = docs.join(small_ids(ids), match, "left_anti")
    changed = only(docs, ids.select(own + "id"), F.col("doc_id") == F.col(own + "id"))
    new = {"text": F.col(own + "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length(own + "text").cast(docs.schema["n_chars"].dataType)
    return same.unionByName(changed.join(found, match).withColumns(new).select(*docs.columns))


def repeat_levels(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, row, length``: the longest of the lengths window, 2 * window, ... at which a text repeats another.

    Copies of all words are represented by the smallest doc_id of their class.
    """
    docs = docs.select("doc_id", "text")
    _, level = candidates(docs, *_signed(docs, window), window)
    length, found = window, []
    while True:
        level = staged(level.join(repeated(level, ["k0", "k1"]).select("k0", "k1"), ["k0", "k1"]), "level")
        if level.isEmpty():
            break
        found.append(level.select("doc_id", "row", F.lit(length).alias("length")).distinct())
        after = level.select("doc_id", "row", (F.col("place") - length).alias("place"), F.col("k0").alias("a0"), F.col("k1").alias("a1"))
        level = level.join(after, ["doc_id", "row", "place"])
        level = level.select("doc_id", "row", "place", F.xxhash64("k0", "k1", "a0", "a1").alias("k0"), F.xxhash64("a1", "a0", "k1", "k0").alias("k1"))
        length *= 2
    if not found:
        return level.select("doc_id", "row", F.lit(0).alias("length"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("doc_id", "row").agg(F.max("length").alias("length"))
