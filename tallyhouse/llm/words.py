"""Column expressions shared by the text operators: words, and a way to name a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once a row however often the body uses it.

    The optimiser merges projections and copies expressions into filters; a lambda variable is never copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def single_spaced(text: Column) -> Column:
    """Is it not empty, and its only white space single spaces between words?"""
    odd = (text == "") | text.contains("  ") | text.startswith(" ") | text.endswith(" ")
    for c in SPACE[1:]:
        odd = odd | text.contains(c)
    return ~odd


def words(text: Column) -> Column:
    """Array of the words of a text, [] if it has none or is null.

    A single-spaced text is split at a character, any other by a pattern.
    """

    def by_pattern(t: Column) -> Column:
        trimmed = F.btrim(t, F.lit(SPACE))
        return let(trimmed, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, SPACE_RUN)))

    return let(F.coalesce(text, F.lit("")), lambda t: F.when(single_spaced(t), F.split(t, " ")).otherwise(by_pattern(t)))
