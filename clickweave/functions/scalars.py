"""Scalar ``Column -> Column`` helpers (all JVM-side built-ins).

Each helper is one Spark SQL expression so it stays inside whole-stage
codegen and can be used inside higher-order functions (``transform``,
``filter``) as well as in plain projections.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of ISO-8601 text that Spark's own cast reads as they stand, ...
ISO_TIMESTAMP_PLAIN = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|\+(?:0\d|1[0-7]):[0-5]\d|-(?:0[1-9]|1[0-7]):[0-5]\d)?)?$"
# ... and all others: calendar or week date, extended or basic; any character
# that is no digit; time, extended or basic, to the hour, minute, second or
# fraction; Z or an offset to the hour, minute, second or fraction.
_ISO_DATE = r"(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2})|-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)"
_ISO_TIME = r"(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?"
_ISO_OFFSET = r"(Z)|([+-])(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?"
ISO_TIMESTAMP_SHAPE = rf"^{_ISO_DATE}(?:[^0-9]{_ISO_TIME}(?:{_ISO_OFFSET})?)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c) -> Column:
    """Python truthiness for a string field: NULL or '' is missing."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def present(c) -> Column:
    return ~is_missing(c)


# The fields of a text of that shape, one after another: year, month, day, week,
# weekday, time, fraction, sign, offset, fraction of the offset. Time and offset
# are six digits if all are given.
_ISO_FIELDS = "$1|$2$4|$3$5|$6$8|$7$9|$10$11$14$12$15|$13$16|$18|$19$20$23$21$24|$22$25"


def _iso_time(parts: Column) -> Column:
    """The fields of ``_ISO_FIELDS`` as TIMESTAMP, NULL if there is no such day or time."""
    year, month, day, week, weekday, time, fraction, sign, offset, rest = (F.get(parts, i) for i in range(10))
    # week 1 has 4 January in it; a week or day that the year hasn't gives another ISO year
    monday = F.date_trunc("week", F.to_date(F.concat(year, F.lit("-01-04"))))
    nth = F.when(weekday == "", F.lit(1)).otherwise(weekday.try_cast("int"))
    by_week = F.when(nth.between(1, 7), F.date_add(monday.cast("date"), (week.try_cast("int") - 1) * 7 + nth - 1))
    by_week = F.when(F.extract(F.lit("YEAROFWEEK"), by_week) == year.cast("int"), by_week.cast("string"))
    date = F.when(week != "", by_week).otherwise(F.concat_ws("-", year, month, day))
    clock = F.regexp_replace(F.rpad(time, 6, "0"), "^(..)(..)(..)$", "T$1:$2:$3.")
    local = F.unix_micros(F.try_to_timestamp(F.concat(date, clock, F.rpad(F.substring(fraction, 1, 6), 6, "0"))))
    o = F.rpad(offset, 6, "0")
    hours, minutes, seconds = (F.substring(o, i, 2).cast("int") for i in (1, 3, 5))
    shift = ((hours * 60 + minutes) * 60 + seconds).cast("long") * 1_000_000 + F.rpad(F.substring(rest, 1, 6), 6, "0").cast("int")
    utc = local - F.when(sign == "-", -shift).otherwise(shift)
    return F.when((hours < 24) & (minutes < 60) & (seconds < 60), F.timestamp_micros(utc))


def _rare_iso_timestamp(c: Column) -> Column:
    """ISO-8601 text of any shape in ``ISO_TIMESTAMP_SHAPE``: taken apart once, then arithmetic on its fields."""
    fields = F.split(F.regexp_replace(c, ISO_TIMESTAMP_SHAPE, _ISO_FIELDS), r"\|", -1)
    # a one-element array binds the fields to a name
    return F.get(F.transform(F.array(fields), _iso_time), 0)


def parse_iso_timestamp(c) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL when the text is not ISO-8601.

    ``try_to_timestamp`` alone also accepts ``2024``, ``2024-7-1`` and
    ``now``; the shape guards reject those first. The common shapes go to it
    as they are; basic formats, week dates, commas, hours alone and other
    offsets are taken apart, which only rows of such a shape pay for.
    Offset-less text is read in the session time zone (UTC), a date as its
    midnight, a week as its Monday; digits beyond microseconds are cut.
    """
    c = _c(c)
    return F.when(c.rlike(ISO_TIMESTAMP_PLAIN), F.try_to_timestamp(c)).when(c.rlike(ISO_TIMESTAMP_SHAPE), _rare_iso_timestamp(c))


def to_double(c) -> Column:
    """JSON number (kept as text) to DOUBLE; NULL if not a finite number."""
    d = _c(c).try_cast("double")
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def bad_number(c) -> Column:
    """A value is there, but it is not a finite number."""
    c = _c(c)
    return c.isNotNull() & to_double(c).isNull()


def to_bigint(c) -> Column:
    """JSON number to BIGINT. ``20`` and ``20.0`` give 20, ``1.5`` gives NULL."""
    c = _c(c)
    d = c.try_cast("double")
    whole = (F.abs(d) < F.lit(9.3e18)) & (d == F.rint(d))
    return F.coalesce(c.try_cast("bigint"), F.when(whole, d.try_cast("bigint")))


def decode_base64(c) -> Column:
    """Base64 text to bytes, NULL on bad input (``unbase64`` would not fail)."""
    return F.try_to_binary(_c(c), F.lit("base64"))


def utf8_text(c) -> Column:
    """Bytes to STRING, NULL when the bytes are not valid UTF-8."""
    return F.try_validate_utf8(_c(c).cast("string"))


def event_unique_id(session_id, pos, event_type, timestamp_text) -> Column:
    """Deterministic event id: sha256 of ``session|pos|type|timestamp``.

    The reference draws a random uuid4, which makes task retries and
    replays produce different ids; a content hash makes them dedupable.
    """
    return F.sha2(
        F.concat_ws("|", _c(session_id), _c(pos).cast("string"), _c(event_type), _c(timestamp_text)),
        256,
    )


def shard_label(c, num_shards: int) -> Column:
    """Stable hash-mod shard as two digits ('00'..)."""
    return F.format_string("%02d", F.pmod(F.xxhash64(_c(c)), F.lit(num_shards)))


def minute_label(ts) -> Column:
    """File-name minute label, e.g. ``2024-07-01-T-10-05``."""
    return F.date_format(F.date_trunc("minute", _c(ts)), "yyyy-MM-dd-'T'-HH-mm")


def iso_text(ts) -> Column:
    """TIMESTAMP to ISO-8601 text with microseconds and no zone."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# Exact product of the amounts that occur: prices below 10**15 to nine
# decimals, quantities below 10**14. Anything larger is summed as DOUBLE.
EXACT_PRICE, EXACT_QUANTITY = "decimal(24,9)", "decimal(14,0)"


def money_exact(price, quantity) -> Column:
    """price * quantity as DECIMAL, unrounded; NULL if either is NULL or out of the exact range."""
    return F.try_multiply(_c(price).try_cast(EXACT_PRICE), _c(quantity).try_cast(EXACT_QUANTITY))


def money_rest(price, quantity) -> Column:
    """price * quantity as DOUBLE where the exact product does not hold it, else NULL."""
    return F.when(money_exact(price, quantity).isNull(), _c(price).cast("double") * _c(quantity).cast("double"))


def money_of(exact, rest) -> Column:
    """Total in money, rounded once to cents: sums of ``money_exact`` and ``money_rest`` (NULL counts as 0)."""
    cents = F.round(F.coalesce(_c(exact), F.lit(0)), 2).cast("double")
    return F.when(_c(rest).isNull(), cents).otherwise(F.round(cents + _c(rest), 2))


def money_sum(price, quantity) -> Column:
    """Aggregate: ``round(sum(price * quantity), 2)``; no row can fail it."""
    return money_of(F.try_sum(money_exact(price, quantity)), F.sum(money_rest(price, quantity)))


def whole_sum(c) -> Column:
    """Aggregate: sum of BIGINT values (NULL counts as 0); NULL if the total is no BIGINT."""
    return F.sum(F.coalesce(_c(c), F.lit(0)).cast("decimal(38,0)")).try_cast("bigint")
