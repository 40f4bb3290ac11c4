from clickweave.functions.scalars import (  # noqa: F401
    decode_base64,
    event_unique_id,
    is_missing,
    minute_label,
    parse_iso_timestamp,
    present,
    shard_label,
    to_bigint,
    to_double,
    utf8_text,
)
