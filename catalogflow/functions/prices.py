"""Prices, points, ratings and stock codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalogflow.functions.text import cut, first_between


def price_text(c: Column, keep_comma: bool = True) -> Column:
    """Only the digits and separators of a price text."""
    return F.regexp_replace(c, "[^0-9,.]+" if keep_comma else "[^0-9.]+", "")


def price_text_each(values: Column, keep_comma: bool = False) -> Column:
    """:func:`price_text` on every value of an array."""
    return F.transform(values, lambda v: price_text(v, keep_comma))


def price_value(c: Column) -> Column:
    """A price text as a decimal; null when it is not a number."""
    return price_text(c, keep_comma=False).try_cast("decimal(18,2)")


def labelled_price(c: Column, unit: str = "Kr") -> Column:
    """The amount in ``label: 12 unit``: the text after the colon without unit and spaces."""
    amount = F.replace(cut(c, ":", 1), F.lit(unit), F.lit(""))
    return F.replace(amount, F.lit(" "), F.lit(""))


def drop_last(c: Column, count: int = 2) -> Column:
    """The text without its last ``count`` characters."""
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - count, F.lit(0)))


def loyalty_points(price: Column) -> Column:
    """Price times 100 cut to an integer, in binary floating point (19.99 gives 1998)."""
    return (price.try_cast("double") * 100).cast("bigint")


def stock_code(c: Column) -> Column:
    """Map an availability code to a stock value; other codes stay as they are."""
    # Site availability codes and the stock values published for them.
    return F.when(c == "NOT_AVAILABLE", "NOT_IN_STOCK").when(c == "ADVANCED_SALE_LIMITED", "IN_STOCK").otherwise(c)


def stock_text(c: Column, in_stock: str = "In stock") -> Column:
    """Stock value of a visible availability text; anything but the given text is not in stock."""
    return F.when(c == in_stock, "IN_STOCK").otherwise("NOT_IN_STOCK")


def stock_upper(c: Column) -> Column:
    """``in_stock`` in upper case, other values unchanged, ``IN_STOCK`` when there is none."""
    return F.when(c == "in_stock", F.upper(c)).otherwise(F.coalesce(c, F.lit("IN_STOCK")))


def stock_unless(c: Column) -> Column:
    """In stock unless the out-of-stock element (a text or a list of texts) is present."""
    return F.when(c.isNull(), "IN_STOCK").otherwise("NOT_IN_STOCK")


def stock_flag(c: Column) -> Column:
    """Stock value of a feed's active flag."""
    return F.when(F.lower(c).isin("0", "false"), "NOT_IN_STOCK").otherwise("IN_STOCK")


def rating(c: Column, default: str = "0.0") -> Column:
    """The number between ``Rating:`` and ``out``, spaces ignored; ``default`` when absent."""
    return F.coalesce(first_between(F.replace(c, F.lit(" "), F.lit("")), "Rating:", "out"), F.lit(default))
