"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns
of one role form a run under one pair of marks, its turns joined by a separator
that repeats the mark, so the original turns can be read back; the pieces are
concatenated. Control strings all begin with ``[`` or ``<``; these two and ``&``
are escaped inside texts and role names (``&#91;``, ``&lt;``, ``&amp;``), so a text
can hold any control string and still come back unchanged.

Template, by role (fixed values): system ``[SYS]..[/SYS]``, user ``[INST]..[/INST]``,
assistant ``<s>..</s>``, another role r ``[ROLE=r]..[/ROLE]``, no role ``[NOROLE]..[/NOROLE]``;
a further turn of the same run begins with the same mark with a plus sign
(``[+INST]``). The loss mask is a list of (start, chars) spans of the formatted
string (code points, from 0): each assistant turn's text, without its marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# role: (mark, closing mark); a mark's plus form follows from it
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    for raw, safe in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def _by_role(role: Column, known: int, other: Column, none: str) -> Column:
    out = F.when(role.isNull(), F.lit(none))
    for name, marks in MARKS.items():
        out = out.when(role == name, F.lit(marks[known]))
    return out.otherwise(other)


def _opening(role: Column) -> Column:
    name = F.replace(escape(role), F.lit("]"), F.lit("&#93;"))
    return _by_role(role, 0, F.concat(F.lit("[ROLE="), name, F.lit("]")), "[NOROLE]")


def _closing(role: Column) -> Column:
    return _by_role(role, 1, F.lit("[/ROLE]"), "[/NOROLE]")


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, formatted, loss array<struct<start, chars>>), a row per conversation.

    A null text is empty; a null role has marks of its own; a null conv_id is
    one conversation; null turn numbers come first; equal turn numbers are
    ordered by role, then text. An empty table gives no rows; other columns
    are ignored. A conversation is one output row, so its text must fit one
    (2 GB).
    """
    row = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    talks = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        before, after = F.get("turns", i - 1), F.get("turns", i + 1)
        joins = (i > 0) & t["role"].eqNullSafe(before["role"])
        ends = (i == F.size("turns") - 1) | ~t["role"].eqNullSafe(after["role"])
        mark = _opening(t["role"])
        plus = F.concat(F.substring(mark, 1, 1), F.lit("+"), F.substring(mark, F.lit(2), F.length(mark)))
        return F.struct(
            F.when(joins, plus).otherwise(mark).alias("mark"),
            escape(t["text"]).alias("body"),
            F.when(ends, _closing(t["role"])).otherwise("").alias("close"),
            F.coalesce(t["role"] == "assistant", F.lit(False)).alias("loss"),
        )

    pieces = talks.select("conv_id", F.transform("turns", piece).alias("pieces"))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start: bigint, chars: bigint>>)").alias("spans"))

    def span(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.length(p["mark"])
        chars = F.length(p["body"]).cast("long")
        spans = F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(start.alias("start"), chars.alias("chars"))))).otherwise(acc["spans"])
        return F.struct((start + chars + F.length(p["close"])).alias("at"), spans.alias("spans"))

    return pieces.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["mark"], p["body"], p["close"])), "").alias("formatted"),
        F.aggregate("pieces", empty, span, lambda acc: acc["spans"]).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the original turns of a formatted string."""
    parts = F.filter(F.split(formatted, r"(?=[\[<])"), lambda p: (p != "") & ~p.rlike(r"^[\[<]/"))

    def turn(p: Column) -> Column:
        # a mark ends at the closing sign that belongs to its opening one
        mark = F.concat(F.regexp_extract(p, r"^\[\+?([^\]]*)\]", 1), F.regexp_extract(p, r"^<\+?([^>]*)>", 1))
        role = F.when(mark == "NOROLE", F.lit(None).cast("string"))
        for name, marks in MARKS.items():
            role = role.when(mark == marks[0][1:-1], F.lit(name))
        role = role.otherwise(unescape(F.replace(F.substring(mark, F.lit(6), F.length(mark)), F.lit("&#93;"), F.lit("]"))))
        return F.struct(role.alias("role"), unescape(F.regexp_replace(p, r"^(?:\[[^\]]*\]|<[^>]*>)", "")).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, s["chars"].cast("int")))), "")
