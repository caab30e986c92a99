"""Suffixes for numbered variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LETTERS = 14  # letters enough for every position a bigint can hold
# The first position that has one letter, two letters and so on, and what a letter counts by its place from the right.
_FIRST = "array(%s)" % ", ".join(f"{sum(26**n for n in range(1, length))}L" for length in range(1, _LETTERS + 1))
_WORTH = "array(%s)" % ", ".join(f"{26**n}L" for n in range(_LETTERS))


def letters(position: Column) -> Column:
    """``a`` to ``z`` for positions 0 to 25, then ``aa``, ``ab`` and so on."""
    p = position.cast("bigint")
    length = F.size(F.filter(F.expr(_FIRST), lambda first: first <= p))
    past = p - F.element_at(F.expr(_FIRST), length)
    letter = lambda i: F.char(F.call_function("div", past, F.get(F.expr(_WORTH), i)) % 26 + 97)
    many = F.array_join(F.transform(F.sequence(length - 1, F.lit(0), F.lit(-1)), letter), "")
    return F.when(p < 26, F.char(p + 97)).when(p >= 26, many)


def digits(position: Column) -> Column:
    """The position as text."""
    return position.cast("string")
