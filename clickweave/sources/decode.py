"""Decoding of session records.

The decode step yields one row per input record with three columns the
rest of the package relies on:

* ``rec``            - the parsed session ``STRUCT`` (all leaves STRING)
* ``reject_reason``  - NULL for a usable record, else why it is unusable
* ``source``         - where the record came from (file path, message id)

Unusable records are not dropped: ``operators.extract.rejects`` turns
them into rows of the rejects table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.scalars import decode_base64, is_missing, utf8_text
from clickweave.schemas import ATTRIBUTES, CORRUPT_COL, PUSH_ENVELOPE, SESSION_PARSE

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT_COL,
    "allowSingleQuotes": "false",
}

# Fixed value: the white space that JSON allows around a value.
JSON_SPACE = " \t\r\n"

# Reject reasons at record level.
BAD_JSON = "bad_json"
MISSING_SESSION_ID = "missing_session_id"
EMPTY_MESSAGE = "empty_message"
BAD_ENCODING = "bad_encoding"
BAD_ENVELOPE = "bad_envelope"


def read_jsonl(spark: SparkSession, path: str | list[str], glob: str | None = "*.jsonl", recursive: bool = False) -> DataFrame:
    """One row per line of the matching text files (gz/bz2 by extension).

    ``source`` is the file path from the hidden ``_metadata`` column, so
    rejects and metrics can be traced to files. Splittable files are read
    in parallel splits; a single ``.gz`` is one task, so callers with few
    large compressed files should ``repartition`` after the read.
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if path == []:
        return spark.createDataFrame([], "value string, source string")
    df = reader.text(path)
    return df.select("value", F.col("_metadata.file_path").alias("source"))


def _session_struct(text: Column) -> Column:
    return F.from_json(text, SESSION_PARSE, JSON_OPTIONS)


def parse_sessions(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse JSON text into ``rec`` and classify the record.

    A record is ``bad_json`` when the text is not one JSON object: parse
    failure, a wrong-typed member (``"events": "x"``), a non-object value,
    single quotes, a blank line, or anything but JSON white space (blank,
    tab, line feed, carriage return) around the object. The parser itself
    stops after the first object, so a second, shallow parse reads the text
    as the only element of an array, which text after the object breaks.
    Duplicate keys: the last one wins, as with the reference.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != value_col]
    text = F.col(value_col)
    parsed = _session_struct(text)
    trimmed = F.btrim(text, F.lit(JSON_SPACE))
    alone = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<struct<session_id:string>>", JSON_OPTIONS)) == 1
    shape_ok = trimmed.startswith("{") & trimmed.endswith("}") & alone
    # Parse exactly once per record: the one-element explode is a Generate,
    # and Catalyst does not copy a generator's output expression into later
    # filters or projections (a plain alias gets inlined, which re-parsed
    # the text for every reference).
    out = df.select(*keep, text.alias("value"), F.explode(F.array(parsed)).alias("_p"))
    bad = F.col("_p").isNull() | F.col(f"_p.{CORRUPT_COL}").isNotNull() | ~F.coalesce(shape_ok, F.lit(False))
    reason = F.when(bad, F.lit(BAD_JSON)).when(is_missing(F.col("_p.session_id")), F.lit(MISSING_SESSION_ID))
    return out.select(
        *keep,
        "value",
        F.col("_p").dropFields(CORRUPT_COL).alias("rec"),
        reason.alias("reject_reason"),
    )


def decode_message_data(df: DataFrame, data_col: str = "data") -> DataFrame:
    """Message bytes -> ``value`` text, or a record-level reason.

    Empty or absent data is ``empty_message`` (acknowledged and skipped
    by the reference); bytes that are not UTF-8 are ``bad_encoding``.
    """
    data = F.col(data_col)
    text = utf8_text(data)
    pre_reason = F.when(data.isNull() | (F.length(data) == 0), F.lit(EMPTY_MESSAGE)).when(
        text.isNull(), F.lit(BAD_ENCODING)
    )
    return df.withColumn("value", text).withColumn("_pre_reason", pre_reason)


def parse_messages(df: DataFrame, data_col: str = "data") -> DataFrame:
    """Decode + parse a normalised message frame (message_id, publish_time, attributes, data)."""
    keep = [c for c in df.columns if c not in (data_col, "value")]
    dec = decode_message_data(df, data_col)
    if "source" not in keep:
        dec = dec.withColumn("source", F.col("message_id"))
        keep = keep + ["source"]
    parsed = parse_sessions(dec, "value", keep=keep + ["_pre_reason"])
    return parsed.withColumn(
        "reject_reason", F.coalesce(F.col("_pre_reason"), F.col("reject_reason"))
    ).drop("_pre_reason")


def decode_push_envelopes(df: DataFrame, body_col: str = "body") -> DataFrame:
    """HTTP push body -> normalised message columns.

    The body is ``{"message": {"data": <base64>, "messageId", "publishTime",
    "attributes"}}``. A body without ``message`` is ``bad_envelope`` (the
    reference answers 400); a ``message`` without ``data`` is accepted and
    writes nothing (``empty_message``); bad base64 is ``bad_encoding``.
    """
    # one-element explode: parse each body once (see parse_sessions)
    df = df.select(F.explode(F.array(F.from_json(F.col(body_col), PUSH_ENVELOPE, JSON_OPTIONS))).alias("_env"))
    env = F.col("_env")
    msg = env["message"]
    raw = msg["data"]
    data = decode_base64(raw)
    out = df.select(
        F.coalesce(msg["messageId"], msg["message_id"]).alias("message_id"),
        F.try_to_timestamp(F.coalesce(msg["publishTime"], msg["publish_time"])).alias("publish_time"),
        F.map_entries(msg["attributes"]).cast(ATTRIBUTES).alias("attributes"),
        data.alias("data"),
        F.when(env.isNull() | env[CORRUPT_COL].isNotNull() | msg.isNull(), F.lit(BAD_ENVELOPE))
        .when(raw.isNull(), F.lit(EMPTY_MESSAGE))
        .when(data.isNull(), F.lit(BAD_ENCODING))
        .alias("_env_reason"),
    )
    parsed = parse_messages(out)
    return parsed.withColumn(
        "reject_reason", F.coalesce(F.col("_env_reason"), F.col("reject_reason"))
    ).drop("_env_reason")


def usable(parsed: DataFrame) -> DataFrame:
    """Records without a record-level reject reason."""
    return parsed.where(F.col("reject_reason").isNull())
