"""Chat formatting of typed content parts, with DataFrame functions only.

A turn's content is an ordered array of parts ``struct<type,text,ref,tokens>``. A visitor turns
each part into text: a text part is escaped, an attachment becomes a placeholder
``<|image:2|>`` numbered over the conversation, its reference and expanded token count recorded. Turns
are joined by the template::

    <|im_start|>role\\ntext<|im_end|>\\n

Escaping: in roles and texts every control string, that is ``<`` (or ``[``) followed by any number of
backslashes and then by ``|``, ``s>``, ``/s>``, ``INST]`` or ``/INST]``, gets one more backslash; reading back
takes one away. So no text can end its turn, forge a placeholder or be mistaken for the
marks of another common template, and every text is restored exactly.

One conversation is one output value, so its turns meet in one row: that is the format, and it
bounds a row by the longest conversation. No other rows are gathered.

Defined cases: a null or empty text is empty; null roles are the empty role; a null part or an
attachment without a reference still takes its place; turns with equal numbers are ordered by
role and text, repeated rows stay; a null conversation id is one conversation; null turns come
first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = r"([<\[])(\\*)(\||/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(\||/?s>|/?INST\])"
PART = "struct<type:string,text:string,ref:string,tokens:bigint>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role's text on one line."""
    line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n"))
    return escape(line)


def unescape_role(role: Column) -> Column:
    line = unescape(role)
    return F.replace(F.replace(line, F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A turn's text as its only part."""
    empty = F.lit(None).cast("string")
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), empty.alias("ref"), F.lit(None).cast("bigint").alias("tokens")))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def flatten(parts: Column, before: Column) -> Column:
    """The visitor: parts to one string; ``before`` counts earlier attachments."""

    def visit(part: Column, i: Column) -> Column:
        here = F.size(F.filter(F.slice(parts, F.lit(1), i + 1), lambda p: ~_is_text(p)))
        placeholder = F.concat(F.lit("<|"), part["type"], F.lit(":"), (before + here - 1).cast("string"), F.lit("|>"))
        return F.when(_is_text(part), escape(F.coalesce(part["text"], F.lit("")))).otherwise(placeholder)

    return F.concat_ws("", F.transform(parts, visit))


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns(conv_id, turn, role, parts)``.

    ``formatted``; ``segments``, an array of ``struct<role,start,length>`` that places every turn's escaped
    text in it (code points, from 0); and ``attachments``, an array of ``struct<type,ref,tokens,turn>`` in
    placeholder order, whose token counts a model reader expands placeholders to.
    """
    role = F.coalesce("role", F.lit("")).alias("role")
    none = F.array().cast(f"array<{PART}>")
    rows = turns.select("conv_id", F.struct("turn", role, F.coalesce("parts", none).alias("parts")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    n_before = lambda i: F.aggregate(  # noqa: E731  attachments of the turns before
        F.slice("turns", F.lit(1), i), F.lit(0), lambda n, t: n + F.size(F.filter(t["parts"], lambda p: ~_is_text(p)))
    )
    spoken = grouped.withColumn(
        "said",
        F.transform(
            "turns",
            lambda t, i: F.struct(
                t["role"].alias("role"),
                F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head"),
                F.when(F.forall(t["parts"], _is_text), flatten(t["parts"], F.lit(0))).otherwise(flatten(t["parts"], n_before(i))).alias("body"),
            ),
        ),
    )
    tail = f"{END}\n"
    ends = F.aggregate(
        "said",
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<role:string,start:bigint,length:bigint>>").alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["head"]) + F.length(s["body"]) + len(tail)).cast("bigint").alias("at"),
            F.concat(
                acc["out"],
                F.array(F.struct(s["role"].alias("role"), (acc["at"] + F.length(s["head"])).cast("bigint").alias("start"), F.length(s["body"]).cast("bigint").alias("length"))),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    attached = F.flatten(
        F.transform(
            "turns",
            lambda t: F.transform(
                F.filter(t["parts"], lambda p: ~_is_text(p)),
                lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), F.coalesce(p["tokens"], F.lit(0)).alias("tokens"), t["turn"].alias("turn")),
            ),
        )
    )
    return spoken.select(
        "conv_id",
        F.concat_ws("", F.transform("said", lambda s: F.concat(s["head"], s["body"], F.lit(tail)))).alias("formatted"),
        ends.alias("segments"),
        attached.alias("attachments"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns``, an array of ``struct<role,text>``, parsed from ``formatted`` alone.

    A raw start or end mark is the template's own, for texts hold only escaped ones."""
    pieces = F.slice(F.split("formatted", r"<\|im_start\|>"), F.lit(2), F.greatest(F.size(F.split("formatted", r"<\|im_start\|>")) - 1, F.lit(0)))
    return formatted.withColumn("pieces", pieces).withColumn("turns", F.transform("pieces", _turn)).drop("pieces")


def _turn(piece: Column) -> Column:
    head = F.length(F.regexp_extract(piece, r"(?s)^(.*?)\n", 1))
    inner = piece.substr(head + 2, F.length(piece) - head - 2 - len(END))
    return F.struct(unescape_role(piece.substr(F.lit(1), head)).alias("role"), unescape(inner).alias("text"))
