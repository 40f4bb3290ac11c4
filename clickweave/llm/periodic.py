"""Runs of periodic words in documents, by scale-tiled search.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), of at least ``max(min_length, times * q)`` words, that no
neighbouring word extends.

Method. A document is exploded into overlapping tiles for each octave of
periods: the tiles of an octave overlap by the longest run that has to be
seen whole, so a run is found in at least one tile, and in every tile that
holds enough of it. (The octaves whose tiles would be shorter than ``TILE``
words share tiles of that length; a document of two such tiles or less is one
tile for all octaves.) Tiles are solved on their own: in the octave [m, 2m) the
multiples of m are boundaries, and any run covers the m words after one of
them and, q words on, their copy. So the block hash at a boundary is compared
with those of the next m places, one vector comparison a word and octave;
where it recurs q words on, the boundary's Z values at q, how far the tile
agrees with itself shifted by q ahead of the boundary and back from it, give
the stretch. Periods whose first q words are a power of something shorter are
none. What the tiles of a document found is shuffled by document and period,
and fragments that overlap are stitched.

Plan: one pass over the texts; documents of at most two tiles are solved where
they stand, longer ones are dealt by tile first, so one very long text
occupies many tasks. Only rows with a fragment carry their words on; fragments
are narrow. No document's fragments meet in one task before they are
stitched, and what is gathered by document is its runs.

Words and windows are known by 64-bit hashes (see ``words``).

Defined results: a null, empty or blank text has no words and no runs; rows
are told apart by doc_id and text, so rows that share a doc_id have their own
runs each, and repeated rows the same ones; a null doc_id is carried along;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.words import Powers, WordHashes
from clickweave.session import staged

MIN_LENGTH, TIMES = 6, 4
#: Words of a tile's core; as many of the next tile's follow it.
TILE = 1 << 12
#: Candidates whose Z values are looked up at a time.
SLAB = 1 << 16

Words = Callable[[object, bytes], list[bytes]]


def plain_words(doc_id: object, text: bytes) -> list[bytes]:
    return text.split()


def prime_divisors(q: int) -> tuple[int, ...]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return (*found, q) if q > 1 else tuple(found)


class Solver:
    """Stretches of a tile at which it agrees with itself shifted by a period."""

    def __init__(self, min_length: int = MIN_LENGTH, times: int = TIMES) -> None:
        if times < 3:
            raise ValueError("a run has three times its period at least")
        self.min_length, self.times, self._powers = min_length, times, Powers()
        self._divisors: dict[int, tuple[int, ...]] = {}

    def __call__(self, hashes: np.ndarray, shortest: int, longest: int) -> list[tuple[int, int, int]]:
        """``period, start, stop`` for periods in ``[shortest, longest)``: words start to stop equal those a period on.

        ``shortest`` and ``longest`` are powers of two. Stretches are maximal in the tile.
        """
        n = len(hashes)
        self.n, (up, self.down) = n, self._powers.upto(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * up[:n], out=self.prefix[1:], dtype=np.uint64)
        found: list[tuple[int, int, int]] = []
        m = shortest
        while m < longest and n >= max(self.min_length, self.times * m):
            found += self._octave(m)
            m *= 2
        return found

    def _octave(self, m: int) -> list[tuple[int, int, int]]:
        block = (self.prefix[m:] - self.prefix[:-m]) * self.down[: self.n - m + 1]
        rows = len(block) // m
        grid = block[: rows * m].reshape(rows, m)
        at, ahead = np.nonzero(grid[1:] == grid[:-1, :1])
        if rows * m < len(block):
            more = np.flatnonzero(block[rows * m :] == block[(rows - 1) * m])
            at, ahead = np.append(at, np.full(len(more), rows - 1)), np.append(ahead, more)
        found: set[tuple[int, int, int]] = set()
        for i in range(0, len(at), SLAB):
            b, q = at[i : i + SLAB] * m, ahead[i : i + SLAB] + m
            ahead_z = self.z_ahead(b, b + q)
            start, stop = b - self.z_back(b, b + q), b + ahead_z
            long = stop - start >= np.maximum(self.min_length - q, (self.times - 1) * q)
            found.update(zip(q[long].tolist(), start[long].tolist(), stop[long].tolist(), strict=True))
        return [x for x in found if self._primitive(x[1], x[0])]

    def _same(self, i: np.ndarray, j: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        p, d = self.prefix, self.down
        return (p[i + length] - p[i]) * d[i] == (p[j + length] - p[j]) * d[j]

    def _steps(self) -> list[int]:
        return [1 << k for k in range(self.n.bit_length() - 1, -1, -1)]

    def z_ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that starts at ``i`` and at ``j`` > ``i``."""
        z = np.zeros(len(i), np.int64)
        for step in self._steps():
            room = np.flatnonzero(j + z + step <= self.n)
            good = room[self._same(i[room] + z[room], j[room] + z[room], step)]
            z[good] += step
        return z

    def z_back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common stretch that ends before ``i`` and before ``j`` > ``i``."""
        z = np.zeros(len(i), np.int64)
        for step in self._steps():
            room = np.flatnonzero(i - z - step >= 0)
            good = room[self._same(i[room] - z[room] - step, j[room] - z[room] - step, step)]
            z[good] += step
        return z

    def _primitive(self, start: int, q: int) -> bool:
        """Whether the ``q`` words at ``start`` are no power of fewer words."""
        if q not in self._divisors:
            self._divisors[q] = prime_divisors(q)
        at = np.array([start])
        return not any(self._same(at, at + q // r, q - q // r)[0] for r in self._divisors[q])


def tiling(n: int, tile: int = TILE, times: int = TIMES) -> list[tuple[int, int, int, int]]:
    """``start, stop, shortest, longest`` of the tiles of ``n`` words: all octaves of periods, each on tiles of its scale."""
    top = 1 << max(1, n.bit_length())
    if n <= 2 * tile:
        return [(0, n, 1, top)]
    out, core, low = [], tile, 1
    high = 1 << (tile // times).bit_length() - 1
    while low * times <= n:
        out += [(start, min(n, start + 2 * core), low, high) for start in range(0, max(1, n - core), core)]
        low, high, core = high, 2 * high, 2 * core
    return out


_TILE_FIELDS = "row long, n_words long, sha256 string, words binary, tile int, tiles int, start long, shortest long, longest long"


def _tiler(words_of: Words, tile: int, times: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        hashes = WordHashes()
        for batch in batches:
            for doc_id, row, text in zip(batch.column("doc_id"), batch.column("row"), batch.column("text"), strict=True):
                value = text.as_py()
                words = words_of(doc_id.as_py(), value.encode()) if value else []
                joined, codes = b" ".join(words), hashes.of(words)
                tiles = tiling(len(words), tile, times)
                for i, (start, stop, low, high) in enumerate(tiles):
                    first = i == 0
                    yield doc_id, row, len(words), hashlib.sha256(joined).hexdigest() if first else None, joined if first else None, i, len(tiles), start, low, high, codes[start:stop]

    return cut


def _tile_rows(words_of: Words, tile: int, times: int):
    """Rows of tiles, for the shuffle."""
    names = ["doc_id", *(x.split()[0] for x in _TILE_FIELDS.split(", ")), "codes"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _tiler(words_of, tile, times)(batches):
            doc_id, row, n, sha, words, *numbers, codes = x
            plain = [pa.array([n], pa.int64()), pa.array([sha], pa.string()), pa.array([words], pa.binary())]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            plain += [pa.array([v], k) for v, k in zip(numbers, kinds, strict=True)]
            yield pa.record_batch([pa.array([doc_id.as_py()], doc_id.type), pa.array([row.as_py()], pa.int64()), *plain, pa.array([codes.view(np.int64)], pa.list_(pa.int64()))], names=names)

    return rows


_SOLVED = "row long, n_words long, sha256 string, words binary, tile int, tiles int, fragments array<struct<period long, start long, stop long>>"
_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _solved_batches(tiles: Iterator[tuple], solver: Solver, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def batch() -> pa.RecordBatch:
        kinds = [id_type, pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), _FRAGMENTS]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        names = ["doc_id", *(x.split()[0] for x in _SOLVED.split(", ", 6))]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    held = 0
    for doc_id, row, n, sha, words, tile, count, start, low, high, codes in tiles:
        found = [{"period": q, "start": start + a, "stop": start + b} for q, a, b in solver(codes, low, high)]
        carried = words if found or count > 1 else None
        rows.append((doc_id.as_py(), row.as_py(), n, sha, carried, tile, count, found))
        held += len(carried or b"") + 48 * len(found) + 64
        if held > 1 << 22:
            yield batch()
            rows.clear()
            held = 0
    yield batch()


def _solve_texts(words_of: Words, tile: int, min_length: int, times: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            again = (x for part in ([first], batches) for x in part)
            yield from _solved_batches(_tiler(words_of, tile, times)(again), Solver(min_length, times), first.schema.field("doc_id").type)

    return solve


def _solve_tiles(min_length: int, times: int):
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in ("n_words", "sha256", "words", "tile", "tiles", "start", "shortest", "longest")]
            for doc_id, row, codes, *rest in zip(batch.column("doc_id"), batch.column("row"), batch.column("codes"), *plain, strict=True):
                yield doc_id, row, *rest, codes.values.to_numpy().view(np.uint64)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is not None:
            again = (x for part in ([first], batches) for x in part)
            yield from _solved_batches(tiles(again), Solver(min_length, times), first.schema.field("doc_id").type)

    return solve


def solved(docs: DataFrame, words_of: Words = plain_words, min_length: int = MIN_LENGTH, times: int = TIMES, tile: int = TILE) -> DataFrame:
    """Written table of all tiles with their fragments; ``words`` of a document go with its first tile, where needed."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    # two tiles of words have at least so many characters and the spaces between them
    one = F.coalesce(F.char_length("text") < 4 * tile, F.lit(True))
    short = rows.where(one).mapInArrow(_solve_texts(words_of, tile, min_length, times), f"doc_id {id_type}, {_SOLVED}")
    tiles = rows.where(~one).mapInArrow(_tile_rows(words_of, tile, times), f"doc_id {id_type}, {_TILE_FIELDS}, codes array<long>")
    dealt = tiles.repartition("doc_id", "row", "tile")
    return staged(short.unionByName(dealt.mapInArrow(_solve_tiles(min_length, times), f"doc_id {id_type}, {_SOLVED}")), "tiles")


def stitched(tiles: DataFrame) -> DataFrame:
    """``doc_id, row, start, length, period`` of every run, from the fragments of its tiles."""
    key = ["doc_id", "row", "period"]
    parts = tiles.select("doc_id", "row", F.explode("fragments").alias("f")).select("doc_id", "row", "f.*")
    order = Window.partitionBy(*key).orderBy("start", "stop")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("opens", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    parts = parts.withColumn("number", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    runs = parts.groupBy(*key, "number").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.select("doc_id", "row", "start", (F.col("stop") - F.col("start") + F.col("period")).alias("length"), "period")


def periodic_runs(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, row, start, length, period`` of every run of every text (``row`` is the text's hash)."""
    return stitched(solved(docs, **how))


def without_copies(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those that a run ``(start, length, period)`` has after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, covered in zip(words, np.cumsum(edge)[:-1].tolist(), strict=True) if not covered]


_DIGEST = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(x.split()[0] for x in _DIGEST.split(", "))]
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    for batch in batches:
        rows = []
        for words, sha, found in zip(*(batch.column(c) for c in ("words", "sha256", "runs")), strict=True):
            runs = [(r["start"], r["length"], r["period"]) for r in found.as_py() or ()]
            best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
            milli = 1000 * best[1] // best[2] if runs else None
            lines = "".join(f"{a},{b},{q}\n" for a, b, q in sorted(runs, key=lambda r: (r[0], r[2])))
            kept = hashlib.sha256(b" ".join(without_copies(words.as_py().split(b" "), runs))).hexdigest() if runs else sha.as_py()
            rows.append((len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), kept))
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)


def run_digests(docs: DataFrame, **how) -> DataFrame:
    """``doc_id``, the longest run and digests of all runs and of the collapsed words, one row per row of ``docs``."""
    tiles = solved(docs.select("doc_id", "text"), **how)
    whole = tiles.where("tile = 0")
    bare = whole.where((F.col("tiles") == 1) & (F.size("fragments") == 0))
    rest = whole.where((F.col("tiles") > 1) | (F.size("fragments") > 0)).select("doc_id", "row", "words", "sha256")
    runs = stitched(tiles).groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    runs = staged(runs, "runs")
    found = rest.join(runs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left").select("doc_id", "words", "sha256", "runs")
    none = F.lit(None).cast("long")
    plain = bare.select(
        "doc_id", F.lit(0).cast("long").alias("n_runs"), *(none.alias(c) for c in ("start", "length", "period", "exponent_milli")),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("runs_sha256"), F.col("sha256").alias("collapsed_sha256"),
    )
    return plain.unionByName(found.mapInArrow(_digest, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_DIGEST}"))
