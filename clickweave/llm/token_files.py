"""Token files: frequency-ranked ids in byte-aligned variable-length code.

Format. A folder holds ``ranks`` (Parquet: the id of each rank, most frequent
first) and ``tokens`` (flat files). A token file is a run of blocks, each
closed by ``MARK``; a block is a header, the number of ids of each of its
documents, their doc_ids as text, the control bytes and the data bytes. Ids
are written as ranks, one to four bytes each, low byte first; how many is said
by the control bytes, apart from the data: one bit an id where no rank needs
more than two bytes (eight ids a control byte), else two bits (four ids). All
but the first six bytes are XORed with the block's salt, the least number
with which ``MARK`` does not occur in the block.

Decoding looks a control byte up in two tables, the bytes that its ids take
together and the offset of each of them; a running sum over the former places
every id of the block, and numpy gathers them at once.

Plan. (1) One pass encodes the texts to a written table of ids. (2) Counts of
ids, combined in each task, give the ranks; a vocabulary bounds them, and they
alone reach the driver. (3) The table is dealt by ranges of doc_id, sorted
there and streamed into blocks: file numbers and places follow doc_id. A hot
doc_id is split by the place of its rows in the table of step 1. (4) Files are
read by Spark's text source with ``MARK`` as line separator, which splits one
file among tasks; a block is a row. A block ends at the first document that
brings it to ``BLOCK_IDS``, so it is never larger than that and a document.

Defined results: a null or empty text is the end id alone; rows with a null
doc_id come first; rows that share a doc_id follow each other in the order in
which step 1 wrote them, and each has a row of the result; extra columns are
ignored; an empty table gives no rows. Doc_ids are integers or strings.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.llm.tokens import Encoder, default_vocabulary, vocabulary_size
from clickweave.session import staged

END_ID = 0
#: Ids after which a block is closed, and ids of a file.
BLOCK_IDS, FILE_IDS = 1 << 17, 1 << 24
#: Ends a block. No end of it is its beginning, so it is found where it was written only.
MARK = "\0frvb-block-end\n"
_MAGIC, _HEAD, _NONE = b"FRVB", "<QQI", 0xFFFFFFFF
#: Files whose sizes one window adds up.
FILES_A_GROUP = 4096


class Code:
    """Variable-length code with ``bits`` control bits an id."""

    def __init__(self, bits: int) -> None:
        self.bits, self.per = bits, 8 // bits
        shifts = np.arange(self.per) * bits
        self.codes = (np.arange(256)[:, None] >> shifts & (1 << bits) - 1).astype(np.uint8)
        sizes = self.codes.astype(np.int64) + 1
        self.size = sizes.sum(1)
        self.offset = sizes.cumsum(1) - sizes
        self.weight = (1 << shifts).astype(np.uint8)

    def encode(self, ranks: np.ndarray) -> tuple[bytes, bytes]:
        """Control bytes and data bytes."""
        widest = 1 << self.bits
        code = np.zeros(-(-len(ranks) // self.per) * self.per, np.uint8)
        own = code[: len(ranks)]
        for i in range(1, widest):
            own += ranks >= 1 << 8 * i
        places = np.cumsum(own + np.int64(1)) - own - 1
        data = np.empty(len(ranks) + int(own.sum(dtype=np.int64)), np.uint8)
        data[places] = ranks.astype(np.uint8)
        for i in range(1, widest):
            longer = np.flatnonzero(own >= i)
            data[places[longer] + i] = (ranks[longer] >> 8 * i).astype(np.uint8)
        control = (code.reshape(-1, self.per) * self.weight).sum(1, dtype=np.uint8)
        return control.tobytes(), data.tobytes()

    def decode(self, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` ranks of control and data bytes, by table lookup."""
        sizes = self.size[control]
        places = ((np.cumsum(sizes) - sizes)[:, None] + self.offset[control]).ravel()[:n]
        code = self.codes[control].ravel()[:n]
        ranks = data[places].astype(np.uint32)
        for i in range(1, 1 << self.bits):
            longer = np.flatnonzero(code >= i)
            ranks[longer] |= data[places[longer] + i].astype(np.uint32) << np.uint32(8 * i)
        return ranks


def pack_block(doc_ids: list[bytes | None], lengths: np.ndarray, ranks: np.ndarray, before: int, code: Code, mark: bytes = MARK.encode()) -> bytes:
    """A block without its end mark; ``before`` is the number of ids ahead of it in the file."""
    index = np.array([_NONE if x is None else len(x) for x in doc_ids], "<u4")
    body = b"".join((struct.pack(_HEAD, len(ranks), before, len(doc_ids)), lengths.astype("<u8").tobytes(), index.tobytes(), *(x for x in doc_ids if x), *code.encode(ranks)))
    salt, salted = 0, body
    while mark in salted:
        salt += 1
        if salt > 255:
            raise ValueError("the end mark occurs in the block under every salt")
        salted = (np.frombuffer(body, np.uint8) ^ np.uint8(salt)).tobytes()
    return _MAGIC + bytes([salt, code.bits]) + salted


def unpack_block(raw: bytes, codes: dict[int, Code]) -> tuple[list[bytes | None], np.ndarray, np.ndarray, int]:
    """``doc_ids, lengths, ranks, before`` of a block; raises ``ValueError`` on one that is cut."""
    if raw[:4] != _MAGIC:
        raise ValueError("not a block of a token file")
    salt, bits = raw[4], raw[5]
    body = raw[6:] if not salt else (np.frombuffer(raw, np.uint8, offset=6) ^ np.uint8(salt)).tobytes()
    n, before, docs = struct.unpack_from(_HEAD, body)
    at = struct.calcsize(_HEAD)
    lengths = np.frombuffer(body, "<u8", docs, at).astype(np.int64)
    index = np.frombuffer(body, "<u4", docs, at + 8 * docs).tolist()
    at += 12 * docs
    doc_ids: list[bytes | None] = []
    for size in index:
        doc_ids.append(None if size == _NONE else body[at : at + size])
        at += 0 if size == _NONE else size
    code = codes[bits]
    control = np.frombuffer(body, np.uint8, -(-n // code.per), at)
    data = np.frombuffer(body, np.uint8, offset=at + len(control))
    # a last control byte that is not full counts a byte for each id that is not there
    want = int(code.size[control].sum()) - (len(control) * code.per - n)
    if lengths.sum() != n or len(data) != want:
        raise ValueError("a block of a token file is cut")
    return doc_ids, lengths, code.decode(control, data, n), before


def _encoded(vocabulary: str, end_id: int, kind: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            rows = [np.append(encoder.ids(x.as_py() or ""), np.uint32(end_id)).astype(kind).tobytes() for x in batch.column("text")]
            yield pa.record_batch([batch.column("doc_id"), pa.array(rows, pa.binary())], names=["doc_id", "ids"])

    return encode


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the places of its rows' ends among them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(column.buffers()[2] or b"", kind, int(offsets[-1] - offsets[0]) // width, int(offsets[0]))
    return flat, (offsets[1:] - offsets[0]) // width


def frequencies(table: DataFrame, size: int, kind: str) -> DataFrame:
    """``id, n`` of every id in the binary column ``ids``; tasks emit an id once each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            seen += np.bincount(_flat(batch.column("ids"), kind)[0], minlength=size)
        some = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["id", "n"])

    return table.select("ids").mapInArrow(count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def ranked(counts: list[tuple[int, int]], size: int) -> np.ndarray:
    """The id of each rank: most frequent first, equal counts by id; ids that never occur come last."""
    seen = np.zeros(size, np.int64)
    for number, n in counts:
        seen[number] = n
    return np.lexsort((np.arange(size), -seen))


def _blocks(ids_by_rank: np.ndarray, kind: str, bits: int, block_ids: int):
    rank_of = np.empty(len(ids_by_rank), np.uint32)
    rank_of[ids_by_rank] = np.arange(len(ids_by_rank), dtype=np.uint32)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, written = Code(bits), 0
        names: list[bytes | None] = []
        sizes: list[int] = []
        parts: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            nonlocal written
            ranks = np.concatenate(parts)
            block = pack_block(names, np.array(sizes, np.int64), ranks, written, code)
            written += len(ranks)
            names.clear(), sizes.clear(), parts.clear()
            return pa.record_batch([pa.array([block], pa.binary())], names=["block"])

        held = 0
        for batch in batches:
            flat, ends = _flat(batch.column("ids"), kind)
            flat = rank_of[flat]
            for doc_id, first, end in zip(batch.column("doc_id"), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                value = doc_id.as_py()
                names.append(None if value is None else str(value).encode())
                sizes.append(end - first)
                parts.append(flat[first:end])
                held += end - first
                if held >= block_ids:
                    yield closed()
                    held = 0
        if names:
            yield closed()

    return make


def write(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all texts, in ascending order of doc_id, to token files in the new folder ``path``."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    size = vocabulary_size(vocabulary)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    encoded = docs.select("doc_id", "text").mapInArrow(_encoded(vocabulary, end_id, kind), f"doc_id {id_type}, ids binary")
    table = staged(encoded.withColumn("place", F.monotonically_increasing_id()), "ids", compression="zstd")
    counts = [(r["id"], r["n"]) for r in frequencies(table, size, kind).collect()]  # a vocabulary at most
    ids_by_rank = ranked(counts, size)
    spark.createDataFrame(list(enumerate(ids_by_rank.tolist())), "rank int, id int").coalesce(1).write.parquet(f"{path}/ranks")
    files = max(1, -(-sum(n for _, n in counts) // file_ids))
    ordered = table.repartitionByRange(files, "doc_id", "place").sortWithinPartitions("doc_id", "place")
    blocks = ordered.select("doc_id", "ids").mapInArrow(_blocks(ids_by_rank, kind, 1 if size <= 1 << 16 else 2, block_ids), "block binary")
    blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", MARK).text(f"{path}/tokens")


def _decoded(ids_by_rank: np.ndarray, with_ids: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = {bits: Code(bits) for bits in (1, 2)}
        for batch in batches:
            for file, raw in zip(batch.column("file"), batch.column("block"), strict=True):
                doc_ids, lengths, ranks, before = unpack_block(raw.as_py(), codes)
                ids = ids_by_rank[ranks].astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [pa.repeat(file, len(doc_ids)), pa.array([None if x is None else x.decode() for x in doc_ids], pa.string())]
                columns += [pa.array(before + starts), pa.array(lengths), pa.array(crcs, pa.int64())]
                names = ["file", "doc_id", "place", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1:]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.record_batch(columns, names=names)

    return decode


def _ahead(files: DataFrame) -> DataFrame:
    """``file, ahead``: ids in the files before each of ``files(file, n)``, in two steps of bounded windows."""
    files = files.withColumn("group", F.floor(F.col("file") / FILES_A_GROUP))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    groups = files.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(before().orderBy("group")), F.lit(0)).alias("base"))
    inner = F.coalesce(F.sum("n").over(before("group").orderBy("file")), F.lit(0))
    return files.withColumn("inner", inner).join(groups, "group").select("file", (F.col("base") + F.col("inner")).alias("ahead"))


def read(spark: SparkSession, path: str, id_type: str = "long", with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of every document in the folder's token files."""
    ranks = spark.read.schema("rank int, id int").parquet(f"{path}/ranks").orderBy("rank").collect()  # a vocabulary
    ids_by_rank = np.array([r["id"] for r in ranks], np.uint32)
    blocks = spark.read.option("lineSep", MARK).text(f"{path}/tokens")
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    blocks = blocks.select(number.alias("file"), F.col("value").cast("binary").alias("block"))
    schema = "file int, doc_id string, place long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = blocks.mapInArrow(_decoded(ids_by_rank, with_ids), schema)
    found = staged(found, "decoded")
    ahead = staged(_ahead(found.groupBy("file").agg(F.sum("n_tokens").alias("n"))), "files")
    rows = found.join(ahead, "file")
    return rows.select(F.col("doc_id").cast(id_type).alias("doc_id"), (F.col("ahead") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_files(docs: DataFrame, path: str, **how) -> DataFrame:
    """Writes the token files of ``docs`` to ``path`` and reads them back."""
    write(docs, path, **how)
    return read(docs.sparkSession, path, docs.schema["doc_id"].dataType.simpleString())
