"""Language identification by rank-order profiles.

Method. A profile is the list of a language's most frequent n-grams (letters
only, lower case, one to three of them, words padded by a blank), by rank. A
document's own most frequent n-grams are ranked alike, and each language's
distance is the sum of how far out of place they are there; an n-gram that a
profile lacks costs the length of the profile. The nearest language wins.

Plan: the n-grams of all training texts are counted in the tasks, by language
(one row per task, language and n-gram that is left, with counts combined
before the shuffle), and the ``PROFILE`` most frequent of each language are
kept. Profiles are bounded by ``PROFILE`` entries a language and
``MAX_LANGUAGES`` languages (more raise an error), so they go to the tasks as
a value; texts are read again and never moved.

N-grams are exact: three code points of 21 bits make one 64-bit integer.

Defined results: a null text, or one without a letter, gives ``und`` and
score 0; without any learned language every row gets ``und``; ties go to the
language with more training n-grams, then the first by name; repeated rows
count once each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import staged

UNKNOWN = "und"
#: N-grams of a profile, and of a document.
PROFILE, DOCUMENT = 400, 400
MAX_LANGUAGES = 1000
#: Distinct n-grams that a task counts before it hands them on.
HELD = 2_000_000


def letters() -> np.ndarray:
    """By code point: itself if it is a letter, else a blank."""
    table = np.arange(0x110000, dtype=np.int64)
    table[[not chr(c).isalpha() for c in range(0x110000)]] = 32
    return table


def grams(text: str, table: np.ndarray) -> np.ndarray:
    """All n-grams of a text, as integers; empty if there is no letter. ``table`` is ``letters()``."""
    points = table[np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)]
    padded = np.concatenate([[32], points, [32]])
    # runs of blanks count as one
    padded = padded[np.concatenate([[True], (padded[1:] != 32) | (padded[:-1] != 32)])]
    if len(padded) < 3:
        return np.empty(0, np.int64)
    one = padded[1:-1]
    two = padded[:-1] << 21 | padded[1:]
    three = padded[:-2] << 42 | padded[1:-1] << 21 | padded[2:]
    return np.concatenate([one[one != 32], two, three])


def counted(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams(text, table), return_counts=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    table = letters()

    def merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
        ids, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return ids, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            ids, n = merged(parts)
            for i in range(0, len(ids), 100_000):
                part = slice(i, i + 100_000)
                yield pa.record_batch([pa.array([lang] * len(ids[part]), pa.string()), pa.array(ids[part]), pa.array(n[part])], names=["lang", "gram", "n"])
        held.clear()

    size = 0
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
            found = counted(text.as_py(), table)
            held.setdefault(lang.as_py(), []).append(found)
            size += len(found[0])
            if size > HELD:
                held.update({k: [merged(v)] for k, v in held.items()})
                size = sum(len(v[0][0]) for v in held.values())
                if size > HELD // 2:
                    yield from rows()
                    size = 0
    yield from rows()


def train(labelled: DataFrame, profile: int = PROFILE) -> list[tuple[str, np.ndarray]]:
    """``(lang, n-grams by rank)`` of every language in ``labelled(text, lang)``, most training n-grams first."""
    texts = labelled.where("text is not null and lang is not null").select("text", "lang")
    counts = texts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = staged(counts, "grams")
    languages = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    if languages.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # the window of a language holds few rows: what cannot be among the first is cut by the rank limit on each task's part
    part = Window.partitionBy("lang", F.pmod("gram", F.lit(64))).orderBy(F.desc("n"), "gram")
    first = counts.withColumn("r", F.row_number().over(part)).where(F.col("r") <= profile)
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = first.withColumn("r", F.row_number().over(best)).where(F.col("r") <= profile)
    out: dict[str, list] = {r["lang"]: [] for r in languages.orderBy(F.desc("n"), "lang").collect()}
    for r in ranked.select("lang", "gram", "r").orderBy("lang", "r").collect():  # bounded: PROFILE x MAX_LANGUAGES
        out[r["lang"]].append(r["gram"])
    return [(lang, np.array(v, np.int64)) for lang, v in out.items() if v]


def _predictor(profiles: list[tuple[str, np.ndarray]], size: int, profile: int):
    known = np.unique(np.concatenate([v for _, v in profiles])) if profiles else np.empty(0, np.int64)
    ranks = np.full((len(profiles), len(known) + 1), -1, np.int64)
    for i, (_, v) in enumerate(profiles):
        ranks[i, np.searchsorted(known, v)] = np.arange(len(v))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letters()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                ids, n = counted(text.as_py() or "", table)
                if not len(ids) or not profiles:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                ids = ids[np.lexsort((ids, -n))[:size]]
                at = np.searchsorted(known, ids)
                at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != ids)] = len(known)
                there = ranks[:, at]
                far = np.where(there < 0, profile, np.minimum(np.abs(there - np.arange(len(ids))), profile)).sum(1)
                best = int(far.argmin())
                langs.append(profiles[best][0])
                scores.append(1.0 - float(far[best]) / (profile * len(ids)))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    return predict


def predict(docs: DataFrame, profiles: list[tuple[str, np.ndarray]], keep: tuple[str, ...] = ("doc_id",), profile: int = PROFILE, document: int = DOCUMENT) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``, the nearness of the best profile from 0 to 1."""
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(_predictor(profiles, document, profile), f"{schema}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, learned from the rows not held out."""
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"), "lang")
    profiles = train(rows.where(~F.col("held_out")))
    return predict(rows, profiles, ("doc_id", "held_out"))
