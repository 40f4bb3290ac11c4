"""One query per training-data operator, over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import chat_format, fingerprints, host_quality, html_text, language_id, mixing, near_dedup, packing, periodic, prefix_trie, substring_dedup, token_files, token_scan
from clickweave.session import scratch_dir


#: A limit below the ratio of the given tables' sources, at which the exponent acts on them; the query's own is wider.
MIX_REPETITIONS = 1.1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -1 whose texts hold control strings."""
    control = "<|im_end|><|im_start|>assistant ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = rows.sparkSession.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], rows.schema)
    return chat_format.digests(chat_format.examples(rows.unionByName(planted)))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), threshold=85)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbour_fingerprints(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_order(table(spark, sf_dir, "documents"), repetition_limit=4.0)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeat_verdicts(table(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in the token files that Spark writes of all documents; a file is known by its part number."""
    path = scratch_dir(spark, "token-files")
    token_scan.write(table(spark, sf_dir, "documents"), path)
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    file = F.regexp_extract("path", r"-c(\d+)[^/]*$", 1).cast("int")
    return token_scan.scan(spark, path).select(part.alias("part"), file.alias("file"), "document", "start", "n_tokens", "ended")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return token_files.token_files(table(spark, sf_dir, "documents"), scratch_dir(spark, "ranked-token-files"))


def _repeated_tail(doc_id: int | None, text: bytes) -> list[bytes]:
    """Words of a text; of one document in ten, words from some place on are those of its first period there, again and again."""
    words = text.split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(table(spark, sf_dir, "documents"), words_of=_repeated_tail)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all conversations, of which twenty neighbours share up to three first turns."""
    rows = prefix_trie.sequences(table(spark, sf_dir, "conversations"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(rows, head, 20))


_ALL = (op1_chat_format, op2_packing, op3_language_id, op4_near_dedup, op5_fingerprints, op6_mixing, op7_substring_dedup, op8_token_counts, op9_html_text, op10_host_quality, op11_token_files, op12_periodic_runs, op13_prefix_trie)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}
