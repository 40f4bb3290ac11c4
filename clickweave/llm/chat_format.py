r"""Chat formatting by prefix-target expansion.

Method. Every assistant turn becomes an example of its own: all turns before
it are context, and only its reply lies under the loss mask. Turns that
follow the last assistant turn belong to no reply; they (and conversations
without one) give a last example without a target, so that no turn is lost.

Template of a turn: ``<|im_start|>role\ntext<|im_end|>\n``. In texts and roles
``<`` and ``|`` with any number of backslashes between them get one more
backslash, so a control string never occurs inside a text and removing one
backslash gives it back. In roles a line feed is written ``<n``, and ``<``,
backslashes and ``n`` in a row get one more backslash likewise.

Plan: one grouping by conversation (the unit of an example, which must fit a
row), then native array functions; the examples of a conversation are
exploded from its array of formatted turns and never collected again.

Defined results: a null text or role is empty; turns are ordered by turn
number, then role, then text, a null turn first; repeated rows are turns of
their own; rows with a null conv_id form one conversation; extra columns are
ignored; an empty table gives no examples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    # a role must not hold the line feed that ends it
    return F.regexp_replace(F.regexp_replace(escape(role), r"<(\\*)n", r"<\\$1n"), "\n", "<n")


def _unescape_role(role: Column) -> Column:
    return unescape(F.regexp_replace(F.regexp_replace(role, "<n", "\n"), r"<\\(\\*)n", "<$1n"))


def examples(conversations: DataFrame, target_role: str = "assistant") -> DataFrame:
    """``conv_id, example, formatted, loss_start, loss_chars`` of every example.

    The loss mask is the code points ``[loss_start, loss_start + loss_chars)``
    of ``formatted``; both are null in an example without a target.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    rendered = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == target_role).alias("target"),
            F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
        ),
    )
    grouped = grouped.select("conv_id", rendered.alias("turns"), F.size("turns").alias("n"))
    whole = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END)))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: F.get("turns", i - 1)["target"] | (i == F.col("n")))
    each = grouped.withColumn("whole", whole).withColumn("ends", ends).select("conv_id", "turns", "whole", F.posexplode("ends").alias("example", "end"))
    last = F.get("turns", F.col("end") - 1)
    context = F.array_join(F.slice("whole", 1, F.col("end") - 1), "")
    each = each.withColumn("context", context)
    formatted = F.concat("context", F.get("whole", F.col("end") - 1))
    return each.select(
        "conv_id",
        "example",
        formatted.alias("formatted"),
        F.when(last["target"], F.char_length("context") + F.char_length(last["head"])).alias("loss_start"),
        F.when(last["target"], F.char_length(last["body"])).alias("loss_chars"),
    )


def read_back(formatted: Column) -> Column:
    """``array<struct<role, text>>`` of the turns in a formatted example."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda p: p.startswith(START))
    inner = F.transform(parts, lambda p: F.substring(p, F.lit(len(START) + 1), F.char_length(p)))
    head = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        inner,
        lambda p: F.struct(_unescape_role(head(p)).alias("role"), unescape(F.substring(p, F.char_length(head(p)) + 2, F.char_length(p))).alias("text")),
    )


def digests(made: DataFrame) -> DataFrame:
    """What can be read back from examples, one row per conversation."""
    reply = F.coalesce(unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_chars"))), F.lit(""))
    read = made.select("conv_id", "example", F.char_length("formatted").alias("chars"), reply.alias("reply"), "formatted")
    # the last example of a conversation holds all its turns
    grouped = read.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda x: x["reply"]), "").alias("replies"),
        F.sum("chars").alias("formatted_chars"),
    )
    grouped = grouped.withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return grouped.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("replies").cast("long").alias("loss_chars"),
        F.sha2(F.encode("replies", "UTF-8"), 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )
