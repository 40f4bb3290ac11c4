"""Session records with defects, made by rule from the derived ones.

The base tables give clean records only, so no check of the decoder or the
extractors could fail on them. Here each record gets the defect of its user
number modulo 10; the oracles apply the same rules to the base tables.

=== =====================================================================
 0  white space around the record (which JSON allows); prices of items get
    the digits "49" appended
 1  a second object after the record
 2  no session id (empty for user numbers that are 12 modulo 20)
 3  no type in entries at even positions
 4  "not a time" as the timestamp at positions divisible by 3
 5  no order id in purchases
 6  items: no product id at even places, price "NaN" at places 1 modulo 4
 7  an empty message, a blank line
 8  price "Infinity" in cart adds at odd positions
 9  items: a price of 2**100 at place 0, a quantity of 9e18 at place 1;
    as a message, not UTF-8 for user numbers that are 9 modulo 20
=== =====================================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HUGE_PRICE = str(2**100)
HUGE_QUANTITY = "9000000000000000000"


def _user() -> Column:
    return F.substring("rec.user_id", 5, 20).cast("long")


def dirty_records(parsed: DataFrame) -> DataFrame:
    """``message_id, publish_time, value, user`` of the records in ``parsed``, each with its defect."""
    kind = F.pmod(_user(), F.lit(10))
    null = F.lit(None).cast("string")

    first_item = F.coalesce(F.col("rec.first_item_pos").cast("int"), F.lit(0))

    def item(x: Column, i: Column) -> Column:
        first, second = (kind == 9) & (i == 0), (kind == 9) & (i == 1)
        return F.struct(
            F.when((kind == 6) & (i % 2 == 0), null).when(first, "P-huge").when(second, "P-many").otherwise(x["product_id"]).alias("product_id"),
            x["product_name"].alias("product_name"),
            F.when(first, "huge").when(second, "many").otherwise(x["category"]).alias("category"),
            F.when((kind == 6) & (i % 4 == 1), "NaN").when(first, HUGE_PRICE).when(second, "0.5").when(kind == 0, F.concat(x["price"], F.lit("49"))).otherwise(x["price"]).alias("price"),
            F.when(first, "1").when(second, HUGE_QUANTITY).otherwise(x["quantity"]).alias("quantity"),
        )

    def entry(e: Column, i: Column) -> Column:
        v = e["event"]
        d = v["details"]
        purchase, cart = v["event_type"].eqNullSafe(F.lit("purchase")), v["event_type"].eqNullSafe(F.lit("add_item_to_cart"))
        d = F.when(purchase & (kind == 5), d.withField("order_id", null)).when(cart & (kind == 8) & (i % 2 == 1), d.withField("price", F.lit("Infinity"))).otherwise(d)
        d = F.when(purchase & kind.isin(0, 6, 9), d.withField("items", F.transform(d["items"], lambda x, j: item(x, j + first_item)))).otherwise(d)
        return F.struct(
            F.struct(
                F.when((kind == 3) & (i % 2 == 0), null).otherwise(v["event_type"]).alias("event_type"),
                F.when((kind == 4) & (i % 3 == 0), "not a time").otherwise(v["timestamp"]).alias("timestamp"),
                d.alias("details"),
            ).alias("event")
        )

    first = F.coalesce(F.col("rec.first_event_pos").cast("int"), F.lit(0))
    events = F.transform("rec.events", lambda e, i: entry(e, i + first))
    session = F.when(kind == 2, F.when(F.pmod(_user(), F.lit(20)) == 12, "")).otherwise(F.col("rec.session_id"))
    text = F.to_json(F.col("rec").withField("events", events).withField("session_id", session))
    text = F.when(kind == 0, F.concat(F.lit("\n\t"), text, F.lit(" \r\n"))).when(kind == 1, F.concat(text, F.lit(" "), text)).when(kind == 7, "").otherwise(text)
    return parsed.select(F.col("source").alias("message_id"), "publish_time", text.alias("value"), _user().alias("user"))


def dirty_messages(parsed: DataFrame) -> DataFrame:
    """The same records as messages (``data`` BINARY)."""
    data = F.encode("value", "UTF-8")
    bad = F.concat(F.unhex(F.lit("FFFE")), data)
    return dirty_records(parsed).select(
        "message_id", "publish_time", F.array(F.struct(F.lit("origin").alias("key"), F.lit("derived").alias("value"))).alias("attributes"),
        F.when(F.pmod("user", F.lit(20)) == 9, bad).otherwise(data).alias("data"),
    )
