"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, merged where
neighbours have the same role, escaped and joined into one string:

    <turn role="user">first text<next/>second text</turn>
    <turn role="assistant">answer</turn>

Texts are escaped as in markup: ``&`` becomes ``&amp;`` and ``<`` becomes
``&lt;`` (in roles ``"`` becomes ``&quot;`` too), so that no text can hold a
control mark and the original comes back whatever it was. The loss mask is the
flag of each segment: the segments join to the formatted string, and those of
the trained role hold its texts and nothing else.

Turns are sorted by turn number, ties by role and text; a null turn number
comes first. Null texts and roles are empty. Rows that repeat stay. Rows
without a conversation key form one conversation. The formatted string of a
conversation is one value, so that a conversation's turns must meet in one
task; escaping happens before, and every step is linear in the turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, NEXT, CLOSE = '<turn role="', '">', "<next/>", "</turn>\n"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit('"'), F.lit("&quot;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&quot;"), F.lit('"')))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = TRAINED) -> DataFrame:
    """conv, segments (array of text and loss flag) and formatted (the segments joined)."""
    rows = turns.select(
        F.col(conv).alias("c"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("one"),
    )
    # Ties of the turn number go by role and text as they are, so escapes come after the order.
    escaped = lambda one: F.struct(escape_role(one["role"]).alias("role"), escape(one["text"]).alias("text"))
    sorted_turns = rows.groupBy("c").agg(F.transform(F.sort_array(F.collect_list("one")), escaped).alias("turns"))

    def segment(one: Column, i: Column) -> Column:
        first = (i == 0) | (F.get("turns", i - 1)["role"] != one["role"])
        last = (i == F.size("turns") - 1) | (F.get("turns", i + 1)["role"] != one["role"])
        mark = F.when(first, F.concat(F.lit(OPEN), one["role"], F.lit(MIDDLE))).otherwise(F.lit(NEXT))
        return F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(one["text"].alias("text"), (one["role"] == F.lit(trained)).alias("loss")),
            F.struct(F.when(last, F.lit(CLOSE)).otherwise(F.lit("")).alias("text"), F.lit(False).alias("loss")),
        )

    segments = F.flatten(F.transform("turns", segment))
    return sorted_turns.select(F.col("c").alias(conv), segments.alias("segments")).withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string, in order: array of role and text."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turns(block: Column) -> Column:
        role = unescape_role(F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), MIDDLE, 1))
        body = F.substr(block, F.lit(len(OPEN) + len(MIDDLE) + 1) + F.length(F.substring_index(F.substr(block, F.lit(len(OPEN) + 1)), MIDDLE, 1)))
        return F.transform(F.split(body, NEXT), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: s["text"]), ""))
