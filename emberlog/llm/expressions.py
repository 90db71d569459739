"""Small helpers for column expressions of training-text operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ``[^\x20\x09-\x0D]+``
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def spaced_words(text: Column) -> Column:
    """Array of the words between white space; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SPACED_WORD), F.lit(0))


def count_signs(text: Column, signs: str) -> Column:
    """How many characters of ``text`` are among ``signs``."""
    return (F.char_length(text) - F.char_length(F.translate(text, signs, ""))).cast("long")
