"""Prefix trie of conversations, from sorted matrices of turn ids.

Every distinct sequence of the first d turns of a conversation is a node of
depth d; its members are the conversations that start with it.

Method. Conversations are sorted by their turns and dealt to range shards. A
shard is read in blocks; a block is a matrix with a row per conversation and a
column per turn, turn ids numbered in the block and padded with 0. The rows
are put in order by ``numpy.lexsort``; the masks of columns that change from
one row to the next, OR-accumulated from left to right, mark where a node of
each depth starts. All results of a node are sums over its rows, so one
``reduceat`` a depth gives them for all nodes of that depth: members, starts
of nodes one turn deeper (children), last rows that no later row continues
(leaves), and words of all turns from that depth on, of all members and of
node starts alone (their difference is what sharing saves). A node that holds
the first or the last row of a block may go on in the next one. Such boundary
nodes, two paths a block, are recombined by their key; what shards could not
know, how far the first row of a shard agrees with the last row before it, is
mended by sums of negative terms along that path. All other nodes are whole as
they are.

Plan: texts are read once and reduced to two 64-bit hashes and a word count a
turn; turns are gathered by conversation, which is a row. One range shuffle by
(turns, conv_id) splits a conversation that very many share; boundary nodes
are two paths a block, so their shuffle is small. The key of a node is its
depth and two 64-bit XORs of hashes that know their place. Parents' ids are
joined from the boundary nodes only where the parent is one.

Defined results: a null role or text is empty; turns are ordered by number, a
null first, equal numbers by the hash of what is said; rows with a null
conv_id are one conversation, which is the smallest member only where it is
the only one and is written as nothing in lists of ids; repeated rows are
turns of their own; extra columns are ignored; an empty table has no nodes. A
conversation without turns is a member of the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.words import mix
from clickweave.session import staged

WORD = r"[^\x20\x09-\x0D]+"
#: Turns of a shard, about, and most cells of a block's matrix (a longer conversation is a block by itself).
SHARD_TURNS, CELLS = 1 << 20, 1 << 22
#: Turns below which a shard is not worth a task.
LEAST_TURNS = 1 << 12
#: Most rows of a block.
BLOCK_ROWS = 1 << 13
_NO_ID = np.iinfo(np.int64).max


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as ``array<struct<t0, t1, words>>``."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    said = conversations.select(
        "conv_id", "turn", F.xxhash64(role, text).alias("t0"), F.xxhash64(text, F.lit("said by"), role).alias("t1"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "t0", "t1", "words")))
    grouped = said.groupBy("conv_id").agg(ordered.alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["t0"].alias("t0"), t["t1"].alias("t1"), t["words"].alias("words"))).alias("turns"))


def with_shared_heads(rows: DataFrame, head_turns: Column, every: int) -> DataFrame:
    """Conversations whose first ``head_turns`` turns are those of the one with the next lower id divisible by ``every``.

    ``head_turns`` is at most 3 and null for no head; that conversation keeps its turns as they are.
    """
    n = F.coalesce(head_turns, F.lit(0)).cast("int")
    heads = rows.where(F.pmod("conv_id", F.lit(every)) == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, 3).alias("head"))
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    both = rows.withColumn("own_base", base).join(heads, F.col("own_base") == F.col("base"), "left")
    head = F.slice(F.coalesce("head", F.array().cast(both.schema["head"].dataType)), F.lit(1), n)
    return both.select("conv_id", F.concat(head, F.slice("turns", n + 1, F.size("turns"))).alias("turns"))


class Block:
    """Rows of a shard: lengths, and turns one after another."""

    def __init__(self, conv: np.ndarray, lengths: np.ndarray, t0: np.ndarray, t1: np.ndarray, words: np.ndarray) -> None:
        self.conv, self.lengths, self.t0, self.t1, self.words = conv, lengths, t0, t1, words
        self.ends = np.cumsum(lengths)

    def __len__(self) -> int:
        return len(self.conv)

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Block:
        turns = batch.column("turns")
        offsets = turns.offsets.to_numpy()
        flat = turns.values.slice(offsets[0], offsets[-1] - offsets[0]).flatten()
        conv = batch.column("conv_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        return cls(conv, np.diff(offsets).astype(np.int64), *(x.to_numpy(zero_copy_only=False) for x in flat))

    def part(self, i: int, j: int) -> Block:
        a, b = int(self.ends[i] - self.lengths[i]) if i < len(self) else 0, int(self.ends[j - 1]) if j > i else 0
        return Block(self.conv[i:j], self.lengths[i:j], self.t0[a:b], self.t1[a:b], self.words[a:b])

    def joined(self, other: Block) -> Block:
        return Block(*(np.concatenate(x) for x in zip((self.conv, self.lengths, self.t0, self.t1, self.words), (other.conv, other.lengths, other.t0, other.t1, other.words), strict=True)))

    def agrees(self, i: int, other: Block, j: int) -> int:
        """Number of first turns that row ``i`` shares with row ``j`` of ``other``."""
        a, b = self.part(i, i + 1), other.part(j, j + 1)
        n = min(len(a.t0), len(b.t0))
        differ = np.flatnonzero((a.t0[:n] != b.t0[:n]) | (a.t1[:n] != b.t1[:n]))
        return int(differ[0]) if len(differ) else n


def prefix_keys(t0: np.ndarray, t1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the prefixes of 0, 1, ... turns along the last axis."""
    place = mix(np.arange(1, t0.shape[-1] + 1, dtype=np.uint64))
    out = []
    for t, salt in ((t0, 0x9E3779B97F4A7C15), (t1, 0xC2B2AE3D27D4EB4F)):
        hashed = mix(t.astype(np.int64).view(np.uint64) + place * np.uint64(salt))
        keys = np.zeros((*t.shape[:-1], t.shape[-1] + 1), np.uint64)
        np.bitwise_xor.accumulate(hashed, axis=-1, out=keys[..., 1:])
        out.append(keys.view(np.int64))
    return out[0], out[1]


NODE = "kind int, depth int, k0 long, k1 long, p0 long, p1 long, conv_id long, n_convs long, n_children long, n_leaves long, member_words long, start_words long, edge boolean, parent_edge boolean, parent_conv long"
_KINDS = [pa.int32(), pa.int32(), *[pa.int64()] * 10, pa.bool_(), pa.bool_(), pa.int64()]
_NAMES = [x.split()[0] for x in NODE.split(", ")]
#: Kinds of rows: nodes, conversations at the node where they end, and first and last rows of shards.
NODES, ENDS, SIDES = 0, 1, 2


def _ids(conv: np.ndarray) -> pa.Array:
    return pa.array(conv, mask=conv == _NO_ID)


def solve_block(block: Block, before: int | None, after: int | None) -> Iterator[pa.RecordBatch]:
    """Node rows of a block of sorted conversations, and where each conversation ends.

    ``before`` and ``after``: turns that the first (last) row shares with the row ahead of (behind) the
    block; None at the ends of a shard, where that is not known.
    """
    rows, lengths = len(block), block.lengths
    width = int(lengths.max())
    order = np.lexsort((block.t1, block.t0))
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = (np.diff(block.t0[order]) != 0) | (np.diff(block.t1[order]) != 0)
    codes = np.empty(len(order), np.int32)
    codes[order] = np.cumsum(fresh)
    filled = np.arange(width) < lengths[:, None]

    def matrix(flat: np.ndarray) -> np.ndarray:
        out = np.zeros((rows, width), flat.dtype)
        out[filled] = flat
        return out

    ids = matrix(codes)
    order = np.lexsort((block.conv, *ids.T[::-1]))
    ids, filled, lengths, conv = ids[order], filled[order], lengths[order], block.conv[order]
    words = matrix(block.words)[order]
    k0, k1 = prefix_keys(matrix(block.t0)[order], matrix(block.t1)[order])

    changed = np.ones((rows, width), bool)
    np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1, out=changed[1:])
    starts = changed & filled  # of nodes, over all blocks
    starts[0, : before or 0] = False
    last_of = np.zeros(rows, bool)  # rows that end a leaf
    at = np.arange(rows - 1)
    last_of[:-1] = (lengths[:-1] > 0) & changed[at + 1, np.maximum(lengths[:-1] - 1, 0)] if width else False
    last_of[-1] = after is None or after < lengths[-1]

    yield _rows(ENDS, lengths, k0[np.arange(rows), lengths], k1[np.arange(rows), lengths], conv)

    member, started = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    levels = []
    for depth in range(width, -1, -1):
        if depth:
            member += words[:, depth - 1]
            started += words[:, depth - 1] * starts[:, depth - 1]
            first = np.flatnonzero(changed[:, depth - 1])
        else:
            first = np.zeros(1, np.int64)
        total = lambda x: np.add.reduceat(x, first)  # noqa: B023, E731
        child = starts[:, depth].astype(np.int64) if depth < width else np.zeros(rows, np.int64)
        size = np.diff(np.append(first, rows))
        edge = np.zeros(len(first), bool)
        edge[0] = before is None or before >= depth
        edge[-1] |= after is None or after >= depth
        levels.append((first, size, np.minimum.reduceat(conv, first), total(child), total(last_of.astype(np.int64)), total(member), total(started), edge))
    levels.reverse()
    for depth, (first, size, least, children, leaves, of_members, of_starts, edge) in enumerate(levels):
        real = lengths[first] >= depth
        if depth:
            up = levels[depth - 1]
            parent = np.searchsorted(up[0], first, "right") - 1
            p0, p1, parent_edge, parent_conv = k0[first, depth - 1], k1[first, depth - 1], up[-1][parent], _ids(up[2][parent][real])
        else:
            p0 = p1 = np.zeros(1, np.int64)
            parent_edge, parent_conv = np.zeros(1, bool), pa.nulls(int(real.sum()), pa.int64())
        n = int(real.sum())
        columns = [np.full(n, NODES, np.int32), np.full(n, depth, np.int32)]
        columns += [x[real] for x in (k0[first, depth], k1[first, depth], p0, p1)] + [_ids(least[real])]
        columns += [x[real] for x in (size, children, leaves, of_members, of_starts, edge, parent_edge)] + [parent_conv]
        yield pa.record_batch([pa.array(c, k) if isinstance(c, np.ndarray) else c for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def _rows(kind: int, depth: np.ndarray, k0: np.ndarray, k1: np.ndarray, conv: np.ndarray) -> pa.RecordBatch:
    n = len(depth)
    given = {"kind": pa.array(np.full(n, kind, np.int32)), "depth": pa.array(depth.astype(np.int32)), "k0": pa.array(k0), "k1": pa.array(k1), "conv_id": _ids(conv)}
    return pa.record_batch([given[c] if c in given else pa.nulls(n, k) for c, k in zip(_NAMES, _KINDS, strict=True)], names=_NAMES)


def _solve_shard(cells: int, turns_type: pa.DataType):
    def side(shard: int, block: Block, i: int) -> pa.RecordBatch:
        row = block.part(i, i + 1)
        turns = [dict(zip(("t0", "t1", "words"), x, strict=True)) for x in zip(row.t0.tolist(), row.t1.tolist(), row.words.tolist(), strict=True)]
        given = {"kind": pa.array([SIDES], pa.int32()), "depth": pa.array([shard], pa.int32()), "turns": pa.array([turns], turns_type)}
        return pa.record_batch([given[c] if c in given else pa.nulls(1, k) for c, k in zip([*_NAMES, "turns"], [*_KINDS, turns_type], strict=True)], names=[*_NAMES, "turns"])

    def wide(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*batch.columns, pa.nulls(batch.num_rows, turns_type)], names=[*_NAMES, "turns"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        held: Block | None = None  # rows not yet solved; the last one waits for the row behind it
        before: int | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                held = Block.of(batch)
                yield side(shard, held, 0)
            else:
                held = held.joined(Block.of(batch))
            at = 0
            while at < len(held) - 1:
                end = min(at + BLOCK_ROWS, len(held) - 1)
                end = min(end, at + max(1, cells // max(1, int(held.lengths[at:end].max()))))
                after = held.agrees(end - 1, held, end)
                yield from map(wide, solve_block(held.part(at, end), before, after))
                at, before = end, after
            held = held.part(at, len(held))
        if held is not None:
            yield from map(wide, solve_block(held, before, None))
            yield side(shard, held, 0)

    return solve


def _mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms that take back what two neighbouring shards counted twice along the path they share."""
    for batch in batches:
        for turns, following in zip(batch.column("turns"), batch.column("following"), strict=True):
            rows = [Block.of(pa.record_batch([pa.array([0], pa.int64()), pa.array([x.as_py()], x.type)], names=["conv_id", "turns"])) for x in (turns, following)]
            shared = rows[0].agrees(0, rows[1], 0)
            k0, k1 = prefix_keys(rows[1].t0[:shared], rows[1].t1[:shared])
            depth = np.arange(shared + 1)
            words = np.append(rows[1].words[:shared], 0)[::-1].cumsum()[::-1]  # of turns from each depth on
            words = np.append(words[:1], words[:-1])
            n = shared + 1
            none, no, unknown = np.zeros(n, np.int64), np.zeros(n, bool), pa.nulls(n, pa.int64())
            leaf = np.full(n, -1 if shared == rows[0].lengths[0] else 0)
            columns = [none, depth, k0, k1, unknown, unknown, unknown, none, -(depth < shared).astype(np.int64), leaf, none, -words, ~no, no, unknown]
            yield pa.record_batch([pa.array(c.astype(k.to_pandas_dtype())) if isinstance(c, np.ndarray) else c for c, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def _partials(rows: DataFrame, shard_turns: int, cells: int) -> tuple[DataFrame, DataFrame]:
    """Written table of node rows, ends and sides of shards, and the node rows that mend what shards counted twice."""
    rows = staged(rows.select("conv_id", "turns"), "conversations")
    turns = rows.agg(F.sum(F.size("turns") + 1)).first()[0] or 0
    few = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // LEAST_TURNS))
    ranged = rows.repartitionByRange(max(1, few, -(-turns // shard_turns)), "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("t0", "t1", "words")]))
    table = staged(ranged.mapInArrow(_solve_shard(cells, kind), f"{NODE}, turns array<struct<t0 long, t1 long, words long>>"), "trie")
    # two rows a shard, the first before the last
    sides = table.where(F.col("kind") == SIDES).select("turns", F.col("depth").alias("shard"), F.monotonically_increasing_id().alias("place"))
    order = Window.orderBy("shard", "place")
    sides = sides.withColumns({"following": F.lead("turns").over(order), "of": F.lead("shard").over(order)}).where("of > shard")
    return table.drop("turns"), sides.select("turns", "following").mapInArrow(_mended, NODE)


def _digest_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each node, from rows sorted by node and id."""
    key, digest = None, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x], k) for x, k in zip((*key, digest.hexdigest()), (pa.int32(), pa.int64(), pa.int64(), pa.string()), strict=True)], names=["d", "e0", "e1", "ends_sha256"])

    for batch in batches:
        done = []
        for d, a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "k0", "k1", "conv_id")), strict=True):
            if (d, a, b) != key:
                if key is not None:
                    done.append(row())
                key, digest = (d, a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(b"" if conv is None else str(conv).encode())
        yield from done
    if key is not None:
        yield row()


def prefix_trie(rows: DataFrame, shard_turns: int = SHARD_TURNS, cells: int = CELLS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node.

    ``rows`` has a row per conversation, as from ``sequences``.
    """
    partials, mends = _partials(rows, shard_turns, cells)
    nodes = partials.where(F.col("kind") == NODES)
    sums = ("n_convs", "n_children", "n_leaves", "member_words", "start_words")
    edges = nodes.where("edge").unionByName(mends).groupBy("depth", "k0", "k1").agg(
        *(F.max(c).alias(c) for c in ("p0", "p1")), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in sums),
    )
    edges = staged(edges, "boundary-nodes")
    columns = ["depth", "k0", "k1", "conv_id", *sums, "parent_conv"]
    upper = edges.select((F.col("depth") + 1).alias("below"), F.col("k0").alias("u0"), F.col("k1").alias("u1"), F.col("conv_id").alias("parent_conv"))

    def under_edges(frame: DataFrame) -> DataFrame:
        return frame.join(upper, (F.col("depth") == F.col("below")) & (F.col("p0") == F.col("u0")) & (F.col("p1") == F.col("u1")), "left").select(*columns)

    inner = nodes.where("not edge")
    whole = inner.where("not parent_edge").select(*columns)
    whole = whole.unionByName(under_edges(inner.where("parent_edge").drop("parent_conv"))).unionByName(under_edges(edges))
    ends = partials.where(F.col("kind") == ENDS).select("depth", "k0", "k1", "conv_id")
    ends = ends.repartition("depth", "k0", "k1").sortWithinPartitions("depth", "k0", "k1", "conv_id")
    ends = staged(ends.mapInArrow(_digest_ends, "d int, e0 long, e1 long, ends_sha256 string"), "ends")
    made = whole.join(ends, (F.col("depth") == F.col("d")) & (F.col("k0") == F.col("e0")) & (F.col("k1") == F.col("e1")), "left")
    return made.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        (F.col("member_words") - F.col("start_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
