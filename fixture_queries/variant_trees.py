"""Colour, size and bundle variants built from parts (products), suppliers (colours) and lines (sizes)."""

from pyspark.sql import functions as F

from catalogflow.functions.numbering import letters
from catalogflow.operators import variants
from fixture_queries.base import line_ord, query

_LETTER = """CASE WHEN {0} < 26 THEN chr(CAST(97 + {0} AS INTEGER))
                  ELSE chr(CAST(97 + ({0} - 26) // 26 AS INTEGER)) || chr(CAST(97 + ({0} - 26) % 26 AS INTEGER)) END"""
_COLORS_SQL = """
    c AS (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY first_ord, color) - 1 AS pos
          FROM (SELECT l_partkey, l_suppkey, 's' || l_suppkey AS color, min(l_orderkey * 8 + l_linenumber) AS first_ord
                FROM lineitem GROUP BY ALL))"""


def products(t):
    """Parts as root products."""
    return t.part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"))


def colors(t):
    """Suppliers of parts as their colours."""
    return t.lineitem.select(
        F.col("l_partkey").cast("string").alias("product_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("color"),
        line_ord().alias("ord"),
    )


def sizes(t):
    """Quantities of part and supplier as sizes, the first line of each giving its position."""
    key = ["l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("size")]
    firsts = t.lineitem.groupBy(*key).agg(F.min(line_ord()).alias("ord"))  # numbers, which are shorter than the texts they become
    return firsts.select(
        F.col("l_partkey").cast("string").alias("product_id"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("color"),
        F.col("size").cast("string").alias("size"), "ord",
    )


@query("wn_03_letter_numbering", f"""
    WITH {_COLORS_SQL}
    SELECT l_partkey || '_' || {_LETTER.format('pos')} AS product_id, CAST(l_partkey AS VARCHAR) AS master_product_id,
           's' || l_suppkey AS color, pos AS color_pos
    FROM c""")
def _(t):
    return variants.color_rows(colors(t), letters)


@query("hr_01_two_levels", f"""
    WITH {_COLORS_SQL}
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, CAST(NULL AS VARCHAR) AS master_product_id,
           CAST(NULL AS VARCHAR) AS color, 0 AS level
    FROM part
    UNION ALL SELECT l_partkey || '_' || pos, NULL, CAST(l_partkey AS VARCHAR), 's' || l_suppkey, 1 FROM c
    UNION ALL SELECT s_name || '_0', NULL, s_name, 'NO_COLOR', 1 FROM supplier
    UNION ALL SELECT s_name, NULL, NULL, NULL, 0 FROM supplier""")
def _(t):
    bare = t.supplier.select(F.col("s_name").alias("product_id"), F.lit(None).cast("string").alias("name"))
    return variants.two_levels(products(t).unionByName(bare), colors(t))


@query("hr_02_three_levels", f"""
    WITH {_COLORS_SQL},
    z AS (SELECT l_partkey, l_suppkey, size,
                 row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY ord, size) - 1 AS size_pos
          FROM (SELECT l_partkey, l_suppkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS size, min(l_orderkey * 8 + l_linenumber) AS ord
                FROM lineitem GROUP BY ALL))
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, CAST(NULL AS VARCHAR) AS master_product_id,
           CAST(NULL AS VARCHAR) AS color, CAST(NULL AS VARCHAR) AS size, 0 AS level
    FROM part
    UNION ALL SELECT l_partkey || '_' || {_LETTER.format('pos')}, NULL, CAST(l_partkey AS VARCHAR), 's' || l_suppkey, NULL, 1 FROM c
    UNION ALL
    SELECT l_partkey || '_' || {_LETTER.format('pos')} || '_' || {_LETTER.format('size_pos')}, NULL,
           l_partkey || '_' || {_LETTER.format('pos')}, NULL, size, 2
    FROM z JOIN c USING (l_partkey, l_suppkey)""")
def _(t):
    return variants.three_levels(products(t), sizes(t), letters)


@query("jn_05_join_options", """
    WITH c AS (SELECT l_partkey, l_suppkey, s_name AS color FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
               QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey
                                          ORDER BY l_orderkey * 8 + l_linenumber, s_name) = 1)
    SELECT l_partkey, l_suppkey, l_orderkey, CAST(l_quantity AS BIGINT) AS size, color
    FROM lineitem JOIN c USING (l_partkey, l_suppkey)""")
def _(t):
    options = t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey", F.col("l_quantity").cast("bigint").alias("size"))
    names = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("color"))
    shown = t.lineitem.select("l_partkey", "l_suppkey", line_ord().alias("ord")).join(names, "l_suppkey")
    return variants.join_options(options, shown, ["l_partkey", "l_suppkey"])


@query("jn_08_lookup", """
    SELECT p_partkey, p_name, l_returnflag AS flag, l_suppkey AS supplier
    FROM part
    LEFT JOIN (SELECT l_partkey, l_returnflag FROM lineitem
               QUALIFY row_number() OVER (PARTITION BY l_partkey
                       ORDER BY l_orderkey * 8 + l_linenumber DESC, l_returnflag DESC) = 1) f ON f.l_partkey = p_partkey
    LEFT JOIN (SELECT l_partkey, l_suppkey FROM lineitem
               QUALIFY row_number() OVER (PARTITION BY l_partkey
                       ORDER BY l_orderkey * 8 + l_linenumber, l_suppkey) = 1) s ON s.l_partkey = p_partkey""")
def _(t):
    table = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), line_ord().alias("ord"), F.col("l_returnflag").alias("flag"),
        F.col("l_suppkey").alias("supplier"),
    )
    rows = t.part.select("p_partkey", "p_name")
    last = variants.lookup(rows, table, ["p_partkey"], "flag")
    return variants.lookup(last, table, ["p_partkey"], "supplier", keep="first")


_LOOK = "CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END"
_BUNDLE_SQL = f"""
    WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, {_LOOK} AS look, p_type AS line, CAST(p_size AS VARCHAR) AS order_index
               FROM part)
    SELECT look AS product_id, 'Look ' || look AS name, CAST(NULL AS VARCHAR) AS master_product_id, CAST(NULL AS VARCHAR) AS style,
           CAST(NULL AS VARCHAR) AS order_index, 'False' AS normal, 'True' AS shop_look, 'False' AS shop_line, 'IN_STOCK' AS in_stock
    FROM (SELECT DISTINCT look FROM p WHERE look <> '')
    UNION ALL SELECT line, 'Line ' || line, NULL, NULL, NULL, 'False', 'False', 'True', 'IN_STOCK' FROM (SELECT DISTINCT line FROM p)
    UNION ALL SELECT id, name, NULL, NULL, order_index, 'True', 'False', 'False', NULL FROM p
    UNION ALL SELECT look || '_' || id, name, look, id, order_index, NULL, NULL, NULL, NULL FROM p WHERE look <> ''
    UNION ALL SELECT line || '_' || id, name, line, id, order_index, NULL, NULL, NULL, NULL FROM p"""


def bundles(t):
    """Brands as looks and types as lines of the parts; one brand stands for a blank cell."""
    rows = t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"),
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias("look_id"), F.col("p_type").alias("line_id"),
        F.col("p_size").cast("string").alias("order_index"),
    )
    names = lambda c, label: rows.where(F.col(c) != "").select(F.col(c).alias("product_id")).distinct().withColumn(
        "name", F.concat(F.lit(label), "product_id"))
    return variants.bundle_catalog(rows, names("look_id", "Look "), names("line_id", "Line "))


@query("hr_03_bundles", _BUNDLE_SQL)
def _(t):
    return bundles(t)


@query("sl_04_order_index", f"SELECT product_id, style, order_index FROM ({_BUNDLE_SQL}) WHERE style IS NOT NULL "
                            "ORDER BY order_index, product_id")
def _(t):
    members = bundles(t).where(F.col("style").isNotNull())
    return members.select("product_id", "style", "order_index").orderBy("order_index", "product_id")
