"""Best-fit packing by the linear grouping scheme.

Method. Documents become token pieces; only those longer than a sequence are
cut. Large lengths are sorted and dealt into groups of equal cardinality, and
each group is rounded up to its longest piece. For these few sizes the
configuration programme (how many sequences hold which multiset of sizes) is
solved by column generation and rounded down. Actual pieces then replace the
rounded ones, longest first, and all others, small ones above all, go
best-fit into what is left, longest first.

Scale. Pieces of one length are alike, so the plan needs only the histogram
of lengths: at most ``capacity`` numbers reach the driver, whatever the size
of the corpus, and the plan is a list of runs "pieces r..r+m of length L go
to sequences s..s+m at offset o" whose number is bounded by the capacity
likewise. Each piece is numbered within (task, length) while it is made;
offsets of the tasks come from counts, which a shuffle by (task, length) brings
to the pieces, and the plan is looked up by (length, number). No text is
shuffled, and ids only where they are kept.

Defined results: a null text is empty and gives the separator alone; repeated
rows are packed each; a null doc_id is carried along; extra columns are
ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.tokens import Encoder, default_vocabulary
from clickweave.session import staged

CAPACITY = 2048
SEPARATOR = 0
#: Settings that are planned; the plan of fewest sequences is used. Groups of
#: equal cardinality, and the share of a sequence above which a piece is large.
SETTINGS = tuple((groups, large) for groups in (8, 64) for large in (0.25, 0.4, 0.45, 0.5))


def _tokeniser(path: str, capacity: int, separator: int, keep_ids: bool):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, task = Encoder(path), {}, TaskContext.get().partitionId()
        for batch in batches:
            rows, kept = [], []
            for i, text in enumerate(batch.column("text")):
                ids = np.append(encoder.ids(text.as_py() or ""), np.uint32(separator)).astype("<u4")
                start, first = 0, len(ids) % capacity or capacity
                for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                    length = end - start
                    number = seen[length] = seen.get(length, -1) + 1
                    rows.append((i, piece, start, length, zlib.crc32(ids[start:end].tobytes()), number))
                    if keep_ids:
                        kept.append(ids[start:end].astype(np.int32))
                    start = end
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [batch.column("doc_id").take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int32())]
            arrays += [pa.array(c, pa.int64()) for c in columns[2:]] + [pa.array([task] * len(rows), pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "number", "task"]
            if keep_ids:
                from clickweave.llm.words import as_list_array

                arrays.append(as_list_array(kept, pa.int32()))
                names.append("ids")
            yield pa.record_batch(arrays, names=names)

    return pieces


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int, separator: int, keep_ids: bool) -> DataFrame:
    """Written table of all pieces; ``number`` counts the pieces of one length within a task."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, number long, task int" + ", ids array<int>" * keep_ids
    return staged(docs.select("doc_id", "text").mapInArrow(_tokeniser(vocabulary, capacity, separator, keep_ids), schema), "pieces")


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[np.ndarray, int]]:
    """Configurations and how often to use each, from the linear programme with columns made as needed."""
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(columns))
    amounts = inverse @ demand
    for _ in range(rounds):
        worth = inverse.sum(0)
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(sizes.min()), capacity + 1):
            best[room], last[room] = best[room - 1], -1
            fits = np.flatnonzero(sizes <= room)
            values = best[room - sizes[fits]] + worth[fits]
            if values.max() > best[room] + 1e-12:
                last[room] = fits[values.argmax()]
                best[room] = values.max()
        if best[capacity] <= 1 + 1e-7:
            break
        column, room = np.zeros(m), capacity
        while room > 0:
            if last[room] < 0:
                room -= 1
                continue
            column[last[room]] += 1
            room -= int(sizes[last[room]])
        change = inverse @ column
        usable = change > 1e-9
        ratio = np.where(usable, amounts / np.where(usable, change, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = column
        amounts -= ratio[out] * change
        amounts[out] = ratio[out]
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return [(columns[:, i].astype(int), int(amounts[i] + 1e-6)) for i in np.argsort(-(columns * sizes[:, None]).sum(0)) if amounts[i] >= 1 - 1e-6]


class Plan:
    """Runs of pieces placed so far, and of sequences with room."""

    def __init__(self, histogram: np.ndarray, capacity: int) -> None:
        self.left = histogram.astype(np.int64).copy()
        self.capacity, self.sequences = capacity, 0
        self.placed: list[tuple[int, int, int, int]] = []  # length, first number, first sequence, offset
        self.taken = np.zeros_like(self.left)
        self.open: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: first sequence, count

    def put(self, length: int, count: int, sequence: int, offset: int) -> None:
        self.placed.append((length, int(self.taken[length]), sequence, offset))
        self.taken[length] += count
        self.left[length] -= count

    def start(self, lengths: list[int], count: int) -> None:
        """Opens ``count`` sequences that hold one piece of each length."""
        offset = 0
        for length in lengths:
            self.put(length, count, self.sequences, offset)
            offset += length
        self.open[self.capacity - offset].append((self.sequences, count))
        self.sequences += count

    def substitute(self, config: np.ndarray, count: int, groups: list[list[list[int]]]) -> None:
        """Opens ``count`` sequences of a configuration with actual pieces of its groups, longest first."""
        while count > 0:
            lengths, step = [], count
            for g in np.flatnonzero(config):
                need = int(config[g])
                if groups[g] and groups[g][0][1] >= need:
                    step = min(step, groups[g][0][1] // need)
                else:
                    step = 1
            for g in np.flatnonzero(config):
                for _ in range(int(config[g])):
                    if groups[g]:
                        head = groups[g][0]
                        lengths.append(head[0])
                        head[1] -= step
                        if head[1] <= 0:
                            groups[g].pop(0)
            if not lengths:
                return
            self.start(lengths, step)
            count -= step

    def best_fit(self) -> None:
        """All pieces left, longest first, each into the least room that takes it."""
        for length in range(self.capacity, 0, -1):
            room = length
            while self.left[length]:
                while room <= self.capacity and not self.open[room]:
                    room += 1
                n = int(self.left[length])
                if room > self.capacity:
                    fit = self.capacity // length
                    self.start([length] * min(fit, n), max(1, n // fit))
                    room = length
                    continue
                first, count = self.open[room].pop()
                if count > n:
                    self.open[room].append((first + n, count - n))
                    count = n
                self.put(length, count, first, self.capacity - room)
                self.open[room - length].append((first, count))
                if room - length >= length:
                    room = length


def plan_packing(histogram: np.ndarray, capacity: int, settings: tuple[tuple[int, float], ...] = SETTINGS) -> tuple[np.ndarray, int]:
    """Runs ``(length, first number, first sequence, offset)`` in order, and the number of sequences."""
    best = min((_planned(histogram, capacity, *s) for s in settings), key=lambda p: p.sequences)
    return np.array(sorted(best.placed), np.int64).reshape(-1, 4), best.sequences


def _planned(histogram: np.ndarray, capacity: int, groups: int, large: float) -> Plan:
    plan = Plan(histogram, capacity)
    lengths = np.arange(capacity, int(capacity * large), -1)
    counts = histogram[lengths]
    if (total := int(counts.sum())) > 0:
        each = max(1, -(-total // groups))
        members: list[list[list[int]]] = []
        room = 0
        for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
            while count:
                if not room:
                    members.append([])
                    room = each
                take = min(room, count)
                members[-1].append([length, take])
                room, count = room - take, count - take
        sizes = np.array([g[0][0] for g in members])
        merged: dict[int, list[list[int]]] = {}
        for size, group in zip(sizes.tolist(), members, strict=True):
            merged.setdefault(size, []).extend(group)
        sizes = np.array(sorted(merged, reverse=True))
        rounded = [merged[int(s)] for s in sizes]
        demand = np.array([sum(c for _, c in g) for g in rounded], float)
        for config, count in configurations(sizes, demand, capacity):
            plan.substitute(config, count, rounded)
    plan.best_fit()
    return plan


def _placer(runs: np.ndarray):
    keys = runs[:, 0] * (1 << 44) + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "number"))
            at = np.searchsorted(keys, length * (1 << 44) + number, "right") - 1
            kept = [(n, batch.column(n)) for n in batch.schema.names if n != "number"]
            found = [("sequence_id", pa.array(runs[at, 2] + number - runs[at, 1])), ("offset", pa.array(runs[at, 3]))]
            yield pa.record_batch([c for _, c in kept + found], names=[n for n, _ in kept + found])

    return place


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, separator: int = SEPARATOR, keep_ids: bool = False, settings: tuple[tuple[int, float], ...] = SETTINGS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and ``ids`` if asked for."""
    pieces = token_pieces(docs, vocabulary or default_vocabulary(), capacity, separator, keep_ids)
    counts = staged(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # at most `capacity` rows
        histogram[length] = n
    runs, _ = plan_packing(histogram, capacity, settings)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("task", "length", F.coalesce(before, F.lit(0)).alias("before"))
    # offsets grow with the number of tasks, so both sides are shuffled: pieces are a few numbers each
    numbered = pieces.join(offsets.hint("merge"), ["task", "length"]).withColumn("number", F.col("number") + F.col("before"))
    columns = [c for c in pieces.columns if c not in ("task", "number")]
    schema = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns) + ", sequence_id long, offset long"
    return numbered.select(*columns, "number").mapInArrow(_placer(runs), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of packed pieces that kept their ids; a sequence has at most ``capacity`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
