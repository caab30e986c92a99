"""Catalogue rows: normalise, de-duplicate, split by URL, back-fill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.operators.joins import join_reduced
from catalogflow.operators.ordering import first_rows

# The placeholder that stands for a missing URL, and the URL schemes a sheet may hold.
NO_URL = "http://no-url.invalid/"
SCHEMES = ("http://", "https://")


def normal_url(c: Column, placeholder: str = NO_URL) -> Column:
    """Trimmed URL; a value without a scheme becomes the placeholder."""
    has_scheme = c.contains(SCHEMES[0]) | c.contains(SCHEMES[1])
    return F.trim(F.when(has_scheme, c).otherwise(placeholder))


def normal_id(c: Column, is_float: bool = False) -> Column:
    """Id as trimmed text; a float cell is cut to its integer part."""
    return F.trim(c.cast("bigint").cast("string") if is_float else c.cast("string"))


def has_url(url: Column, rule: str = "sheet", placeholder: str = NO_URL) -> Column:
    """Whether a row has a URL: ``sheet`` means not the placeholder, ``db`` means it starts with ``http://``."""
    if rule == "sheet":
        return url.isNotNull() & (url != placeholder)
    if rule == "db":
        return F.coalesce(url.startswith(SCHEMES[0]), F.lit(False))
    raise ValueError(f"unknown rule {rule!r}")


def split_by_url(catalog: DataFrame, rule: str = "sheet", placeholder: str = NO_URL) -> tuple[DataFrame, DataFrame]:
    """Rows with a URL and rows without; a sheet's rows without one carry a blank URL."""
    test = has_url(F.col("url"), rule, placeholder)
    without = catalog.where(~test)
    return catalog.where(test), without.withColumn("url", F.lit("")) if rule == "sheet" else without


def with_status(catalog: DataFrame, status: str = "none") -> DataFrame:
    """Set the initial status."""
    return catalog.withColumn("status", F.lit(status))


def first_by_id(
    catalog: DataFrame, key: str = "product_id", order: tuple[str, ...] = ("ord",), scope: tuple[str, ...] = (),
    drop_blank: bool = False,
) -> DataFrame:
    """First row of every product id inside ``scope``; blank ids are dropped, or one is kept."""
    rows = catalog.where(F.col(key) != "") if drop_blank else catalog
    return first_rows(rows, [*scope, key], order)


def trial(catalog: DataFrame, count: int) -> DataFrame:
    """The first rows of each catalogue, by position."""
    return catalog.where(F.col("ord") < count)


def placeholders(without_url: DataFrame) -> DataFrame:
    """A product row for each catalogue row that has no URL."""
    scope = [c for c in ("catalog_id",) if c in without_url.columns]
    return without_url.select(*scope, "product_id", "name", F.lit("NOT_AVAILABLE").alias("in_stock"))


def backfill_urls(
    catalog: DataFrame, lookup: DataFrame, every_row: bool = False, key: str = "product_id"
) -> DataFrame:
    """Fill blank URLs (or all) from ``lookup(key, url)``; an id that is not found gets a blank.

    Adds ``sought`` and ``found``. Only the rows to fill take part in the join.
    """
    blank = F.lit(True) if every_row else F.coalesce(F.col("url"), F.lit("")) == ""
    kept = [c for c in catalog.columns if c != "url"]
    links = lookup.groupBy(key).agg(F.min("url").alias("_url"))
    sought = join_reduced(catalog.where(blank).drop("url"), links, [key], "left").select(
        *kept, F.coalesce("_url", F.lit("")).alias("url"), F.lit(True).alias("sought"), F.col("_url").isNotNull().alias("found")
    )
    filled = catalog.where(~blank).select(*kept, "url", F.lit(False).alias("sought"), F.lit(False).alias("found"))
    return filled.unionByName(sought)


def backfill_report(filled: DataFrame, *scope: str) -> DataFrame:
    """How many missing links were updated, out of how many."""
    counts = filled.groupBy(*scope).agg(
        F.count_if("found").alias("updated"), F.count_if("sought").alias("missing")
    )
    return counts.withColumn(
        "message", F.format_string("Updated %d out of %d missing links", "updated", "missing")
    )
