"""Colour, size and bundle variants of products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.functions.binding import bound
from catalogflow.functions.numbering import digits
from catalogflow.functions.text import cdata
from catalogflow.operators.joins import join_reduced
from catalogflow.operators.ordering import numbered, numbered_rows, split_large
from catalogflow.session import written

NO_COLOR = "no_color"


def union_rows(*frames: DataFrame) -> DataFrame:
    """Product rows of several builders in one table; columns one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def join_options(sizes: DataFrame, colors: DataFrame, on: list[str]) -> DataFrame:
    """Size options with the colour that has their colour id; each colour counts once, and first."""
    first = colors.groupBy(*on).agg(F.min(F.struct("ord", "color")).alias("_first"))
    return join_reduced(sizes, first, on).withColumn("color", F.col("_first.color")).drop("_first")


def lookup(rows: DataFrame, table: DataFrame, on: list[str], value: str, keep: str = "last") -> DataFrame:
    """Left join to a key → value table in which a repeated key keeps its last (or first) value by ``ord``."""
    pick = F.max if keep == "last" else F.min
    values = table.groupBy(*on).agg(pick(F.struct("ord", value)).alias("_pick"))
    return join_reduced(rows, values, on, "left").withColumn(value, F.col(f"_pick.{value}")).drop("_pick")


def zip_positions(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of two aligned lists kept in long form, joined by position."""
    return left.join(right, [*keys, "pos"])


def color_rows(
    variants: DataFrame, suffix=digits, product: str = "product_id", color: str = "color",
) -> DataFrame:
    """One row per product and colour, numbered by first appearance.

    ``variants`` holds ``(product, color, ord)``. The rows are reduced per colour before numbering.
    """
    firsts = variants.groupBy(product, color).agg(F.min("ord").alias("first_ord"))
    rows = numbered(firsts, [product], ["first_ord", color])
    return rows.select(
        F.concat_ws("_", product, suffix(F.col("pos"))).alias("product_id"),
        F.col(product).alias("master_product_id"),
        F.col(color),
        F.col("pos").alias("color_pos"),
    )


def two_levels(
    products: DataFrame, variants: DataFrame, suffix=digits, no_color: str = "NO_COLOR"
) -> DataFrame:
    """Products and their colour rows; a product without colours gets one row with a marker colour."""
    children = color_rows(variants, suffix)
    bare = products.join(variants.select("product_id").distinct(), "product_id", "left_anti").select(
        F.concat_ws("_", "product_id", suffix(F.lit(0))).alias("product_id"),
        F.col("product_id").alias("master_product_id"),
        F.lit(no_color).alias("color"),
    )
    level = lambda df, n: df.withColumn("level", F.lit(n))
    return union_rows(level(products, 0), level(children.drop("color_pos"), 1), level(bare, 1))


def _placed_by_product(variants: DataFrame, details: list[str], suffix) -> DataFrame:
    """Variants with the id of their colour and their place in it; a product's rows meet in one task, in one shuffle."""
    of_color = Window.partitionBy("product_id", "color")
    place = F.row_number().over(of_color.orderBy("ord", *details))
    rows = variants.repartition("product_id").withColumn("pos", (place - 1).cast("bigint")).withColumn("_first", F.min("ord").over(of_color))
    color = (F.dense_rank().over(Window.partitionBy("product_id").orderBy("_first", "color")) - 1).cast("bigint")
    rows = rows.withColumn("_color", color)
    return rows.select(F.col("product_id").alias("root_id"), "color", F.concat_ws("_", "product_id", suffix(F.col("_color"))).alias("color_id"), "pos", *details)


def _placed_by_ranges(variants: DataFrame, size: int, details: list[str], suffix) -> DataFrame:
    """:func:`_placed_by_product` for products of more rows than one task should sort."""
    colors = color_rows(variants, suffix).select(
        F.col("master_product_id").alias("root_id"), "color", F.col("product_id").alias("color_id"))
    sizes = numbered_rows(variants, size, ["product_id", "color"], ["ord", *details])
    return sizes.withColumnRenamed("product_id", "root_id").join(colors, ["root_id", "color"])


def three_levels(products: DataFrame, variants: DataFrame, suffix=digits) -> DataFrame:
    """Product, colour and size rows with ids ``root``, ``root_c`` and ``root_c_s``.

    ``variants`` holds ``(product_id, color, size, ord)`` and any detail columns, one row per size. A variant without a size
    keeps a null size; one without a colour belongs to ``no_color``. The first size of a colour also yields the colour's row. Products
    that one task can sort take one shuffle; larger ones are cut as in :mod:`catalogflow.operators.ordering`.
    """
    variants, bytes_written = written(variants.withColumn("color", F.coalesce("color", F.lit(NO_COLOR))), "variants")
    details = [c for c in variants.columns if c not in ("product_id", "color", "ord")]
    small, large = split_large(variants.where(F.col("product_id").isNotNull()), bytes_written, ["product_id"])
    placed = _placed_by_product(small, details, suffix)
    if large is not None:
        placed = placed.unionByName(_placed_by_ranges(large, bytes_written, details, suffix).select(*placed.columns))
    none = {c: F.lit(None).cast(variants.schema[c].dataType) for c in ["color", *details]}

    def row(product_id, master, level, **values):
        return F.struct(
            product_id.alias("product_id"), master.alias("master_product_id"), F.lit(level).alias("level"),
            *[values.get(c, empty).alias(c) for c, empty in none.items()],
        )

    color = row(F.col("color_id"), F.col("root_id"), 1, color=F.col("color"))
    size_id = F.concat_ws("_", "color_id", suffix(F.col("pos")))
    size = row(size_id, F.col("color_id"), 2, **{c: F.col(c) for c in details})
    below = placed.select(F.inline(F.when(F.col("pos") == 0, F.array(color, size)).otherwise(F.array(size))))
    return union_rows(products.withColumn("level", F.lit(0)), below)


def record_levels(
    root_id: Column, records: Column, fields: Sequence[str], suffix=digits, no_color: str = NO_COLOR
) -> Column:
    """Colour and size rows of a product whose variant records sit in one array of ``struct(color, fields...)``.

    The result is one array of structs for ``inline``, null for a product without records: a page's records never leave its row, so
    colours keep the order of the page and nothing is shuffled. The records' places are sorted by colour once, and each colour is a slice
    of them, so the work grows with the records and not with colours times records.
    """
    color_of = lambda r: F.coalesce(r["color"], F.lit(no_color))

    def row(product_id, master, color, level, record=None):
        details = [(record[f] if record is not None else F.lit(None).cast("string")).alias(f) for f in fields]
        return F.struct(
            product_id.alias("product_id"), master.alias("master_product_id"), color.alias("color"), F.lit(level).alias("level"), *details
        )

    def color_id(i):
        return F.concat_ws("_", root_id, suffix(i))

    def sizes(run, i):
        none = F.lit(None).cast("string")
        return bound(color_id(i), lambda own: F.transform(run["records"], lambda r, j: row(F.concat_ws("_", own, suffix(j)), own, none, 2, r)))

    def runs(records, sorted_, starts):
        """Each colour with the place of its first record and its records, from their places in order of colour and place."""
        def run(start, k):
            places = F.slice(sorted_, start + 1, F.coalesce(F.get(starts, k + 1), F.size(sorted_)) - start)
            return F.struct(F.get(sorted_, start)["place"].alias("place"), F.get(sorted_, start)["color"].alias("color"),
                            F.transform(places, lambda p: F.get(records, p["place"])).alias("records"))
        return F.transform(starts, run)

    def tree(records):
        places = F.array_sort(F.transform(records, lambda r, i: F.struct(color_of(r).alias("color"), i.alias("place"))))
        return bound(places, lambda sorted_: bound(
            F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda j: (j == 0) | (F.get(sorted_, j)["color"] != F.get(sorted_, j - 1)["color"])),
            lambda starts: bound(runs(records, sorted_, starts), lambda colors: bound(
                F.transform(F.array_sort(F.transform(colors, lambda r, k: F.struct(r["place"].alias("place"), k.alias("k")))), lambda o: F.get(colors, o["k"])),
                lambda order: F.concat(F.transform(order, lambda c, i: row(color_id(i), root_id, c["color"], 1)), F.flatten(F.transform(order, sizes)))))))

    return F.when(F.size(records) > 0, bound(records, tree))


def cross_sell(blocks: Column, product_base: str) -> Column:
    """Recommended products of one page as wrapped JSON objects, each with its product URL.

    ``blocks`` is an array of structs with an ``id``; other fields are packed as they are.
    """
    return F.transform(
        blocks,
        lambda b: cdata(F.to_json(b.withField("product_url", F.concat(F.lit(product_base), b["id"])))),
    )


def bundle_masters(names: DataFrame, kind: str) -> DataFrame:
    """Master rows of looks or lines: ``names`` holds ``(product_id, name)`` and for looks an image URL."""
    return names.select("*", *kind_flags(kind), F.lit("IN_STOCK").alias("in_stock"))


def bundle_members(products: DataFrame, bundle_id: str) -> DataFrame:
    """Rows that place products in the bundle named by a column; blank means in none.

    The member's id is ``bundle_product``; ``order_index`` is carried when present.
    """
    member = products.where(F.coalesce(F.col(bundle_id), F.lit("")) != "")
    kept = [c for c in member.columns if c not in ("product_id", "look_id", "line_id", "master_product_id")]
    return member.select(
        F.concat_ws("_", bundle_id, "product_id").alias("product_id"),
        F.col(bundle_id).alias("master_product_id"),
        F.col("product_id").alias("style"),
        *kept,
    )


def kind_flags(kind: str) -> list[Column]:
    """Which kind of product a row is, as three text flags."""
    return [F.lit(str(kind == k).title()).alias(name)
            for k, name in (("normal", "normal"), ("look", "shop_look"), ("line", "shop_line"))]


def bundle_catalog(products: DataFrame, looks: DataFrame, lines: DataFrame) -> DataFrame:
    """Masters of looks and lines, the products, and their membership rows."""
    normal = products.drop("look_id", "line_id").select("*", *kind_flags("normal"))
    return union_rows(
        bundle_masters(looks, "look"),
        bundle_masters(lines, "line"),
        normal,
        bundle_members(products, "look_id"),
        bundle_members(products, "line_id"),
    )
