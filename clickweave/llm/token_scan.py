"""Token counts of documents in flat, unindexed token files, by separator scan.

Format. A file is a run of little-endian unsigned 16-bit numbers: the ids of
a document, each plus one, then 0 as end of document; no header, no index.

Method. Files are cut into blocks. In each block a vectorised search finds
the separators; it yields how many there are, the tokens before the first and
after the last, and the lengths of the documents that lie inside. A prefix
scan over the blocks of a file then carries the open document and the number
of documents before each block, which stitches documents across any number of
blocks.

Plan: files come through Spark's ``binaryFile`` source (any store Spark
reads; a file has at most 2 GB there, so at most ``2 GB / BLOCK`` block rows
meet in one window); only block summaries are shuffled. ``write`` makes such
files with Spark's text writer: a row is the raw bytes of documents up to
``ROW_BYTES`` or of one longer document, the line separator is the end of the
row's last document, and a file has at most ``FILE_ROWS`` rows. So a file is cut
by its bytes, however long or short texts are.

Defined results: an empty document counts 0 tokens; tokens after the last
separator are a last document with ``ended`` false; an odd last byte raises an
error; a null text is empty; empty files and tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickweave.llm.tokens import Encoder, default_vocabulary, vocabulary_size
from clickweave.llm.words import as_list_array

WIDTH = 2
MOST_IDS = (1 << 8 * WIDTH) - 1
BLOCK = 1 << 18
#: Bytes after which a row of documents is closed, and rows of a file.
ROW_BYTES, FILE_ROWS = 1 << 19, 16


def _encoded(vocabulary: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_size(vocabulary) > MOST_IDS:
            raise ValueError(f"{vocabulary} has more than {MOST_IDS} ids, which {WIDTH} bytes cannot tell from the separator")
        encoder = Encoder(vocabulary)
        held: list[bytes] = []

        def row() -> pa.RecordBatch:
            joined = (b"\0" * WIDTH).join(held)
            held.clear()
            return pa.record_batch([pa.array([joined], pa.binary())], names=["ids"])

        size = 0
        for batch in batches:
            for x in batch.column("text"):
                held.append((encoder.ids(x.as_py() or "") + 1).astype("<u2").tobytes())
                size += len(held[-1]) + WIDTH
                if size >= ROW_BYTES:
                    yield row()
                    size = 0
        if held:
            yield row()

    return encode


def write(docs: DataFrame, path: str, vocabulary: str | None = None) -> None:
    """Writes the ids of all texts to flat token files in the new folder ``path``."""
    rows = docs.select("text").mapInArrow(_encoded(vocabulary or default_vocabulary()), "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\0" * WIDTH).option("maxRecordsPerFile", FILE_ROWS).text(path)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, inner = [], []
        for data in batch.column("data"):
            ids = np.frombuffer(data.as_buffer(), "<u2")
            at = np.flatnonzero(ids == 0)
            rows.append((len(at), int(at[0]) if len(at) else len(ids), len(ids) - 1 - int(at[-1]) if len(at) else len(ids)))
            inner.append(np.diff(at) - 1)
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.record_batch(
            [batch.column("path"), batch.column("block"), *(pa.array(c, pa.int64()) for c in columns), as_list_array(inner, pa.int64())],
            names=["path", "block", "n_ends", "head", "tail", "inside"],
        )


def scan(spark: SparkSession, path: str, block_bytes: int = BLOCK) -> DataFrame:
    """``path, document, start, n_tokens, ended`` of every document, numbered and placed within its file."""
    if block_bytes % WIDTH:
        raise ValueError(f"blocks hold whole numbers of {WIDTH} bytes")
    files = spark.read.format("binaryFile").load(path).where("length > 0")
    whole = F.when(F.col("length") % WIDTH == 0, F.col("content")).otherwise(F.raise_error(F.concat(F.lit("cut token file "), "path")))
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))
    cut = F.transform(starts, lambda i: F.substring(F.col("whole"), (i + 1).cast("int"), F.lit(block_bytes)))
    blocks = files.select("path", "length", whole.alias("whole")).select("path", F.posexplode(cut).alias("block", "data"))
    found = blocks.mapInArrow(_search, "path string, block int, n_ends long, head long, tail long, inside array<long>")

    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    size = F.when(F.col("n_ends") > 0, F.col("head") + F.col("tail") + F.col("n_ends") + F.aggregate("inside", none, lambda a, x: a + x)).otherwise(F.col("head"))
    found = found.withColumn("size", size)
    found = found.withColumns({"documents": F.coalesce(F.sum("n_ends").over(before), none), "tails": F.coalesce(F.sum("tail").over(before), none), "at": F.coalesce(F.sum("size").over(before), none)})
    # the open document: tails since the last block with an end, that block's own included
    found = found.withColumn("since", F.coalesce(F.last(F.when(F.col("n_ends") > 0, F.col("tails")), ignorenulls=True).over(before), none))
    carried = F.col("tails") - F.col("since")
    last = F.lead("block").over(Window.partitionBy("path").orderBy("block")).isNull()
    found = found.withColumns({"carried": carried, "last": last})
    ended = F.when(F.col("n_ends") > 0, F.concat(F.array(F.col("carried") + F.col("head")), F.col("inside"))).otherwise(F.array().cast("array<long>"))
    rest = F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("carried") + F.col("tail"))
    lengths = F.concat(F.transform(ended, lambda n: F.struct(n.alias("n"), F.lit(True).alias("ended"))), F.when(F.col("last") & (rest > 0), F.array(F.struct(rest.alias("n"), F.lit(False).alias("ended")))).otherwise(F.array().cast("array<struct<n:bigint,ended:boolean>>")))
    each = found.select("path", "block", "documents", "carried", "head", "at", "n_ends", F.posexplode(lengths).alias("i", "d"))
    inside = Window.partitionBy("path", "block").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("at") - F.col("carried") + F.coalesce(F.sum(F.col("d.n") + 1).over(inside), none)
    return each.select("path", (F.col("documents") + F.col("i")).alias("document"), start.alias("start"), F.col("d.n").alias("n_tokens"), F.col("d.ended").alias("ended"))
