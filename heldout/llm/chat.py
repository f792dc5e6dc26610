"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as
context, then the turn itself, and only its text is trainable.  A conversation
that does not end with an assistant turn (or has none) also gives one example
with no trainable text, so that every turn is in the output.

A turn is written with the marks of its role:

    system      [SYS] text [/SYS]
    user        [INST] text [/INST]
    assistant   <s>text</s>
    any other   [ROLE]role[/ROLE]text[/TURN]

Marks within a text or role are escaped by a backslash behind their first sign
(``</s>`` is written ``<\\/s>``), and what already looks so gets one more, so
unescaping takes exactly one away and every text comes back as it was.
Everything here is built from DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("[SYS]", "[/SYS]", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]", "<s>", "</s>")
_REST = r"(/?SYS\]|/?INST\]|/?ROLE\]|/TURN\]|/?s>)"
_OPEN = ("[SYS]", "[INST]", "<s>", "[ROLE]")


def escape(text: Column) -> Column:
    """The text with a backslash behind the first sign of each mark."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)\\" + _REST, "$1$2$3")


def _lead(role: Column) -> Column:
    """What stands in front of a turn's text."""
    return (F.when(role == "system", F.lit("[SYS] ")).when(role == "user", F.lit("[INST] "))
            .when(role == "assistant", F.lit("<s>"))
            .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"))))


def _tail(role: Column) -> Column:
    return (F.when(role == "system", F.lit(" [/SYS]")).when(role == "user", F.lit(" [/INST]"))
            .when(role == "assistant", F.lit("</s>")).otherwise(F.lit("[/TURN]")))


def format_examples(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, example, formatted, loss): ``example`` counts a
    conversation's examples from 0, ``loss`` is an array with the span (start,
    length in code points, from 0) of the trainable text, or an empty array.

    ``turns`` has conv_id, turn, role, text; other columns are ignored.  Rows
    go by turn, then role, then text, nulls first; repeated rows are turns like
    others.  Null roles and texts are empty, a null conv_id is a conversation
    of its own.  A conversation is one row, of a size that its turns bound.
    """
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("turns"))
    pieces = whole.withColumn("pieces", F.transform("turns", lambda t: F.struct(
        t["role"].alias("role"), _lead(t["role"]).alias("lead"), escape(t["text"]).alias("text"), _tail(t["role"]).alias("tail"))))
    written = F.transform("pieces", lambda p: F.concat(p["lead"], p["text"], p["tail"]))
    # the place of each example's last turn
    ends = F.filter(F.transform("pieces", lambda p, i: F.when(
        (p["role"] == "assistant") | (i == F.size("pieces") - 1), i)), lambda i: i.isNotNull())
    examples = (pieces.withColumn("written", written).select("conv_id", "pieces", "written", F.posexplode(ends).alias("example", "end"))
                .withColumn("last", F.element_at("pieces", F.col("end") + 1))
                .withColumn("formatted", F.array_join(F.slice("written", F.lit(1), F.col("end") + 1), "")))
    start = (F.length("formatted") - F.length(F.element_at("written", F.col("end") + 1)) + F.length("last.lead")).cast("long")
    return examples.select(
        "conv_id", F.col("example").cast("long").alias("example"), "formatted",
        F.when(F.col("last.role") == "assistant", F.array(F.struct(
            start.alias("start"), F.length("last.text").cast("long").alias("length"))))
        .otherwise(F.array().cast("array<struct<start:bigint,length:bigint>>")).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted example, as they were."""
    # texts hold no mark, so an opening one always starts a turn
    marks = "|".join(m.replace("[", r"\[").replace("]", r"\]") for m in _OPEN)
    found = F.filter(F.split(formatted, f"(?={marks})"), lambda x: x != "")

    def turn(x: Column) -> Column:
        inner = lambda lead, tail: F.substring(x, F.lit(lead + 1), F.length(x) - lead - tail)
        other = inner(6, 7)  # after [ROLE], before [/TURN]
        cut = F.locate("[/ROLE]", other)
        role = (F.when(x.startswith("[SYS]"), F.lit("system")).when(x.startswith("[INST]"), F.lit("user"))
                .when(x.startswith("<s>"), F.lit("assistant")).otherwise(unescape(F.substring(other, F.lit(1), cut - 1))))
        text = (F.when(x.startswith("[SYS]"), inner(6, 7)).when(x.startswith("[INST]"), inner(7, 8))
                .when(x.startswith("<s>"), inner(3, 4)).otherwise(F.substring(other, cut + 7, F.length(other))))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(found, turn)


def read_back(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold: conv_id, turns (role,
    text), loss (the text under each example's mask) and formatted_chars (code
    points of all its examples)."""
    under = F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"].cast("int") + 1, s["length"].cast("int"))))
    row = F.struct("example", F.array_join(under, "").alias("loss"), F.length("formatted").cast("long").alias("chars"))
    return (examples.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("rows"),
                                            F.max(F.struct("example", "formatted")).alias("last"))
            .select("conv_id", read_turns(F.col("last.formatted")).alias("turns"),
                    F.transform("rows", lambda r: r["loss"]).alias("loss"),
                    F.aggregate("rows", F.lit(0).cast("long"), lambda n, r: n + r["chars"]).alias("formatted_chars")))
