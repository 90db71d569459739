"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it as context,
then the reply, and only the reply's text is trainable. A conversation whose turns go
on after the last reply, or that has none, gives one more row without trainable
text, so that the output holds every turn.

Template: ``<<SYS>>text<</SYS>>`` for system, ``[INST]text[/INST]`` for user,
``<s>text</s>`` for assistant turns and ``<<ROLE>>role<<|>>text<</ROLE>>`` for any other
role. Inside texts and role names a backslash goes before each ``\\``, ``<`` and ``[``,
so that no text can hold a mark; ``read_turns`` takes that back exactly.

Turns are ordered by turn number, then role and text; null numbers come first and
repeated rows stay. Null text and null roles are empty; a null conv_id is a conversation
of its own. Further columns are not read. The turns of one conversation must fit a
task, as its last example is a text that holds all of them.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Marks around the text of each role.
_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
_OTHER = ("<<ROLE>>", "<<|>>", "<</ROLE>>")

_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_BODY = r"((?:[^\\<\[]|\\.)*)"
_TURN = re.compile(
    "|".join(re.escape(a) + _BODY + re.escape(b) for a, b in _MARKS.values())
    + "|" + re.escape(_OTHER[0]) + _BODY + re.escape(_OTHER[1]) + _BODY + re.escape(_OTHER[2]),
    re.DOTALL,
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"\\$1")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted example."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        for k, role in enumerate(_MARKS, start=1):
            if m[k] is not None:
                turns.append((role, unescape(m[k])))
        if m[4] is not None:
            turns.append((unescape(m[4]), unescape(m[5])))
        at = m.end()
    return turns


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, loss_start, loss_end, n_turns.

    Characters from loss_start to loss_end (exclusive) are trainable; both are null in a
    row without a reply of its own.
    """
    role, text = F.coalesce("role", F.lit("")), escaped(F.coalesce("text", F.lit("")))
    opening = F.concat(F.lit(_OTHER[0]), escaped(role), F.lit(_OTHER[1]))
    closing = F.lit(_OTHER[2])
    for name, (a, b) in _MARKS.items():
        opening = F.when(role == name, a).otherwise(opening)
        closing = F.when(role == name, b).otherwise(closing)
    turn = F.struct(
        F.col("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("raw"),
        F.concat(opening, text, closing).alias("text"),
        F.char_length(opening).alias("before"), F.char_length(closing).alias("after"),
    )
    talks = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    places = F.sequence(F.lit(1), F.size("turns"))
    targets = F.filter(places, lambda k: (F.element_at("turns", k)["role"] == "assistant") | (k == F.size("turns")))
    rows = talks.select("conv_id", "turns", F.posexplode(targets).alias("example", "k"))
    last = F.element_at("turns", F.col("k"))
    full = F.array_join(F.transform(F.slice("turns", 1, F.col("k")), lambda t: t["text"]), "")
    rows = rows.select("conv_id", "example", "k", full.alias("text"), last.alias("last"))
    reply = F.col("last.role") == "assistant"
    end = F.char_length("text") - F.col("last.after")
    start = F.char_length("text") - F.char_length("last.text") + F.col("last.before")
    return rows.select(
        "conv_id", "example", "text", F.when(reply, start).alias("loss_start"), F.when(reply, end).alias("loss_end"),
        F.col("k").cast("long").alias("n_turns"),
    )


def trained(text: Column, start: Column, end: Column) -> Column:
    """Unescaped text under the loss mask of one example."""
    return F.regexp_replace(F.substring(text, start + 1, end - start), r"(?s)\\(.)", "$1")


def trained_text(rows: pd.DataFrame) -> list[str]:
    """Unescaped text under the loss mask of each example."""
    return [
        "" if pd.isna(a) else unescape(text[int(a) : int(b)])
        for text, a, b in zip(rows["text"], rows["loss_start"], rows["loss_end"], strict=True)
    ]
