"""Catalogue reading, splitting, matching and back-fill."""

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalogflow.operators import catalog as cat
from catalogflow.operators import matching
from catalogflow.operators.ordering import first_rows, sorted_ids
from catalogflow.operators.variants import union_rows
from catalogflow.session import shared_folder
from catalogflow.sources import sheets, tables
from fixture_queries.base import LINE_ORDER, LINE_ORDER_SQL, query

_NO_URL = cat.NO_URL


def order_products(t):
    """Orders read as a product table of many catalogues."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("url"),
        F.col("o_totalprice").cast("string").alias("product_id"), F.lit("none").alias("status"), "o_custkey",
        F.ascii("o_orderstatus").cast("bigint").alias("catalog_id"),
    )


@query("src_01_sheet_layout", f"""
    SELECT c_custkey - 15 AS ord, CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS product_id, c_name AS name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '{_NO_URL}' ELSE 'https://shop.invalid/' || c_mktsegment END AS url
    FROM customer WHERE c_custkey >= 15""")
def _(t):
    link = F.when(F.col("c_mktsegment") == "BUILDING", "none yet").otherwise(
        F.concat(F.lit(" https://shop.invalid/"), "c_mktsegment", F.lit(" ")))
    rows = t.customer.select(
        F.lit("").alias("_c0"), F.col("c_acctbal").alias("_c1"), F.concat(F.lit(" "), "c_name").alias("_c2"), link.alias("_c3"),
        F.col("c_custkey").alias("row"),
    )
    return sheets.apply_layout(rows, sheets.DEFAULT)


@query("src_01_sheet_file", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS product_id, 'said "' || c_name || '",' || chr(10) || c_mktsegment AS name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN '{_NO_URL}' ELSE 'https://shop.invalid/' || c_nationkey END AS url,
           row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 3 AS ord
    FROM customer QUALIFY ord >= 0""")
def _(t):
    path = f"{shared_folder(t.spark)}/sheets-{uuid.uuid4().hex}"
    name = F.concat(F.lit('said "'), "c_name", F.lit('",\n'), "c_mktsegment")
    link = F.when(F.col("c_mktsegment") == "BUILDING", "none").otherwise(F.concat(F.lit(" https://shop.invalid/"), F.col("c_nationkey").cast("string")))
    # a sheet for each nation, cells with commas, quotes and line breaks
    rows = t.customer.select("c_nationkey", F.col("c_custkey").alias("id"), name.alias("name"), link.alias("link"))
    rows = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "id").select("c_nationkey", F.col("id").cast("string"), "name", "link")
    rows.write.partitionBy("c_nationkey").option("escape", '"').csv(path)
    small = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"}  # several tasks for a sheet
    before = {k: t.spark.conf.get(k) for k in small}
    for k, v in small.items():
        t.spark.conf.set(k, v)
    try:
        read, _ = sheets.read_csv(t.spark, path, sheets.Layout(2, {"product_id": 0, "name": 1, "url": 2}))  # writes the sheets' lines
    finally:
        for k, v in before.items():
            t.spark.conf.set(k, v)
    return read.drop("sheet", "file")


@query("src_01_unreadable_sheets", """
    SELECT 103 AS code, 'Error reading excel file' || chr(10) || 'Error occurred for given file: ' || c_nationkey AS message,
           CASE WHEN c_nationkey % 3 = 0 THEN 'a quote is not closed' ELSE 'the sheet has no column 2 for url' END AS reason
    FROM customer WHERE c_nationkey % 3 < 2 GROUP BY c_nationkey""")
def _(t):
    path = f"{shared_folder(t.spark)}/sheets-{uuid.uuid4().hex}"
    third = F.col("c_nationkey") % 3
    open_quote = F.when(F.row_number().over(W.partitionBy("c_nationkey").orderBy("c_custkey")) == 2, ',"x').otherwise(",x")
    line = F.concat(F.col("c_custkey").cast("string"), F.lit(",n"), F.when(third == 0, open_quote).when(third == 1, "").otherwise(",http://x"))
    t.customer.select("c_nationkey", line.alias("line")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(path)
    problems = sheets.read_csv(t.spark, path, sheets.COMPACT)[1]
    nation = F.regexp_extract("file", "c_nationkey=([0-9]+)", 1)  # the files' own names are Spark's
    return problems.select("code", F.replace("message", "sheet", nation).alias("message"), "reason")


@query("src_01_bundle_sheet", f"""
    SELECT p_partkey - 1 AS ord, CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS look_id, p_type AS line_id,
           '{_NO_URL}' AS url
    FROM part WHERE p_partkey >= 1""")
def _(t):
    rows = t.part.select(
        F.col("p_partkey").cast("double").alias("_c0"), F.col("p_brand").alias("_c1"), F.col("p_type").alias("_c2"),
        F.lit("").alias("_c3"), F.col("p_name").alias("_c4"), F.col("p_partkey").alias("row"),
    )
    return sheets.apply_layout(rows, sheets.BUNDLE)


@query("src_02_catalog_select", """
    SELECT o_orderkey AS id, o_orderpriority AS name, o_orderstatus AS url, CAST(o_totalprice AS VARCHAR) AS product_id,
           'none' AS status
    FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT o_orderkey, o_orderpriority, o_orderstatus, CAST(o_totalprice AS VARCHAR), 'none'
    FROM orders WHERE o_orderkey = 42""")
def _(t):
    products = order_products(t)
    return tables.select_catalog(products, ord("O")).unionByName(tables.select_catalog(products, ord("O"), row_id=42))


@query("src_03_catalog_info", """
    SELECT c_custkey AS catalog_id, c_name AS name, c_mktsegment AS file, count(o_orderkey) AS products
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def _(t):
    info = tables.catalog_info(t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("file")))
    counts = order_products(t).groupBy(F.col("o_custkey").alias("catalog_id")).agg(F.count("*").alias("products"))
    return info.join(counts, "catalog_id", "left").withColumn("products", F.coalesce("products", F.lit(0).cast("bigint")))


@query("fl_01_normal_url", f"""
    SELECT page_id, CASE WHEN contains(url, '#') THEN '{_NO_URL}' ELSE url END AS url FROM pages""")
def _(t):
    cell = F.when(F.col("url").contains("#"), F.regexp_replace("url", "^[^#]*#", "")).otherwise(
        F.concat(F.lit("  "), "url", F.lit(" ")))
    return t.pages.select("page_id", cat.normal_url(cell).alias("url"))


@query("fl_02_normal_id", """
    SELECT c_custkey, CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS from_float, c_name AS from_text FROM customer""")
def _(t):
    return t.customer.select(
        "c_custkey", cat.normal_id(F.col("c_acctbal"), is_float=True).alias("from_float"),
        cat.normal_id(F.concat(F.lit(" "), "c_name", F.lit("  "))).alias("from_text"),
    )


@query("fl_03_split_urls", f"""
    WITH c AS (SELECT page_id, CASE WHEN contains(url, '#') THEN '{_NO_URL}' ELSE url END AS url FROM pages)
    SELECT 'sheet' AS rule, page_id, url <> '{_NO_URL}' AS with_url,
           CASE WHEN url <> '{_NO_URL}' THEN url ELSE '' END AS url FROM c
    UNION ALL
    SELECT 'db', page_id, starts_with(url, 'http://'), url FROM c""")
def _(t):
    rows = t.pages.select("page_id", F.when(F.col("url").contains("#"), cat.NO_URL).otherwise(F.col("url")).alias("url"))
    parts = []
    for rule in ("sheet", "db"):
        for part, flag in zip(cat.split_by_url(rows, rule), (True, False), strict=True):
            parts.append(part.select(F.lit(rule).alias("rule"), "page_id", F.lit(flag).alias("with_url"), "url"))
    return union_rows(*parts)


@query("fl_06_initial_status", "SELECT o_orderkey, o_custkey, 'none' AS status FROM orders")
def _(t):
    return cat.with_status(t.orders.select("o_orderkey", "o_custkey"))


def part_lines(t):
    """Order lines as catalogue rows with repeated and blank product ids."""
    blank = F.col("l_quantity") == 1
    return t.lineitem.select(
        F.when(blank, "").otherwise(F.col("l_partkey").cast("string")).alias("product_id"), *LINE_ORDER)


_FIRST_SQL = f"""
    SELECT product_id, {LINE_ORDER_SQL} FROM (
        SELECT CASE WHEN l_quantity = 1 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS product_id, {LINE_ORDER_SQL}
        FROM lineitem)
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY {LINE_ORDER_SQL}) = 1"""


@query("wn_01_first_by_id", f"SELECT * FROM ({_FIRST_SQL}) WHERE product_id <> ''")
def _(t):
    return cat.first_by_id(part_lines(t), order=tuple(LINE_ORDER), drop_blank=True)


@query("wn_02_first_by_id_with_blank", _FIRST_SQL)
def _(t):
    return cat.first_by_id(part_lines(t), order=tuple(LINE_ORDER))


def listed_twice(t):
    """Pages as a catalogue that lists every URL twice."""
    first = t.pages.select(F.col("page_id").alias("ord"), "url", F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("product_id"))
    total = 1_000_000_000
    again = first.select((F.lit(total) - F.col("ord")).alias("ord"), "url", F.concat("product_id", F.lit("b")).alias("product_id"))
    return first.unionByName(again)


@query("jn_01_match_first", """
    SELECT page_id, url AS requested_url, page_id AS ord, 'p' || CAST(page_id AS VARCHAR) AS product_id FROM pages""")
def _(t):
    fetched = t.pages.select("page_id", F.col("url").alias("requested_url"))
    return matching.match_first(fetched, listed_twice(t))


@query("jn_02_match_nth", """
    WITH f AS (SELECT page_id, regexp_extract(url, '^https?://[^/]*') AS requested_url FROM pages),
         a AS (SELECT *, row_number() OVER (PARTITION BY requested_url ORDER BY page_id) AS n FROM f),
         c AS (SELECT *, row_number() OVER (PARTITION BY requested_url ORDER BY page_id DESC) AS n FROM f)
    SELECT a.page_id AS fetch_ord, a.requested_url, 1000000000 - c.page_id AS ord, 'r' || CAST(c.page_id AS VARCHAR) AS product_id
    FROM a JOIN c USING (requested_url, n)""")
def _(t):
    host = F.regexp_extract("url", "^https?://[^/]*", 0)
    fetched = t.pages.select(F.col("page_id").alias("fetch_ord"), host.alias("requested_url"))
    catalog = t.pages.select(
        (F.lit(1_000_000_000).cast("bigint") - F.col("page_id")).alias("ord"), host.alias("url"),
        F.concat(F.lit("r"), F.col("page_id").cast("string")).alias("product_id"),
    )
    return matching.match_nth(fetched, catalog)


def shipped_parts(t):
    """Part ids of all order lines, with repeats; every seventh is shifted to one that no part has."""
    key = F.col("l_partkey")
    return t.lineitem.select(F.when(key % 7 == 0, key + 1_000_000_000).otherwise(key).alias("product_id"))


_LISTED = "SELECT CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS l_partkey FROM lineitem"


@query("jn_03_in_catalog", f"SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN ({_LISTED})")
def _(t):
    return matching.in_catalog(t.part.select("p_partkey", "p_name", "p_brand"), shipped_parts(t), "p_partkey")


@query("jn_04_not_in_feed", f"""
    SELECT p_partkey AS product_id, p_name AS name, 'not_found' AS status FROM part WHERE p_partkey NOT IN ({_LISTED})""")
def _(t):
    catalog = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))
    return matching.not_in_feed(catalog, shipped_parts(t).withColumnRenamed("product_id", "feed_id"), "feed_id")


@query("ag_06_match_ratio", f"""
    SELECT p_brand AS catalog, count(*) AS total, count(*) FILTER (p_partkey NOT IN ({_LISTED})) AS missing,
           CASE WHEN count(*) FILTER (p_partkey NOT IN ({_LISTED})) > 0
                THEN CAST(count(*) FILTER (p_partkey NOT IN ({_LISTED})) AS VARCHAR) || ' id(s) from id list weren''t found in feed'
                ELSE 'All ids found in feed.' END AS message
    FROM part GROUP BY p_brand""")
def _(t):
    catalog = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("catalog"))
    status = matching.feed_status(catalog, shipped_parts(t).withColumnRenamed("product_id", "feed_id"), "feed_id")
    return matching.match_ratio(status, "catalog")


@query("jn_09_id_mismatches", """
    SELECT page_id, sheet_id, site_id, 'Not equal, id in sheet ' || sheet_id || ', on site ' || site_id AS message
    FROM (SELECT page_id, CAST(page_id AS VARCHAR) AS sheet_id, regexp_extract(url, '/([0-9]+)', 1) AS site_id FROM pages)
    WHERE sheet_id <> site_id""")
def _(t):
    fetched = t.pages.select("page_id", F.col("url").alias("requested_url"), F.regexp_extract("url", "/([0-9]+)", 1).alias("site_id"))
    catalog = t.pages.select(F.col("page_id").alias("ord"), "url", F.col("page_id").cast("string").alias("sheet_id"))
    matched = matching.match_first(fetched, catalog)
    return matching.id_mismatches(matched, "sheet_id", "site_id").drop("requested_url", "ord")


def backfilled(t, every_row=False):
    """Pages whose URL is blank without a query, filled from the secure URLs."""
    catalog = t.pages.select(
        F.col("page_id").alias("product_id"), F.when(F.col("url").contains("?"), F.col("url")).otherwise("").alias("url"))
    links = t.pages.where(F.col("url").startswith("https://")).select(F.col("page_id").alias("product_id"), "url")
    return cat.backfill_urls(catalog, links, every_row)


@query("jn_10_backfill", """
    SELECT page_id AS product_id, CASE WHEN contains(url, '?') OR starts_with(url, 'https://') THEN url ELSE '' END AS url,
           NOT contains(url, '?') AS sought, NOT contains(url, '?') AND starts_with(url, 'https://') AS found
    FROM pages""")
def _(t):
    return backfilled(t)


@query("jn_10_backfill_all", """
    SELECT page_id AS product_id, CASE WHEN starts_with(url, 'https://') THEN url ELSE '' END AS url,
           true AS sought, starts_with(url, 'https://') AS found
    FROM pages""")
def _(t):
    return backfilled(t, every_row=True)


@query("ag_06_backfill_report", """
    SELECT count(*) FILTER (NOT contains(url, '?') AND starts_with(url, 'https://')) AS updated,
           count(*) FILTER (NOT contains(url, '?')) AS missing,
           'Updated ' || updated || ' out of ' || missing || ' missing links' AS message
    FROM pages""")
def _(t):
    return cat.backfill_report(backfilled(t))


@query("jn_11_placeholders", """
    SELECT CAST(page_id AS VARCHAR) AS product_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS name,
           'NOT_AVAILABLE' AS in_stock, CAST(NULL AS VARCHAR) AS url
    FROM pages WHERE NOT starts_with(url, 'http://')
    UNION ALL
    SELECT CAST(page_id AS VARCHAR), regexp_extract(html, '<title>(.*?)</title>', 1), 'IN_STOCK', url
    FROM pages WHERE starts_with(url, 'http://')""")
def _(t):
    rows = t.pages.select(
        F.col("page_id").cast("string").alias("product_id"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("name"), "url")
    listed, without = cat.split_by_url(rows, "db")
    return union_rows(listed.withColumn("in_stock", F.lit("IN_STOCK")), cat.placeholders(without))


@query("st_01_union_rows", """
    SELECT p_partkey AS product_id, p_name AS name, CAST(NULL AS VARCHAR) AS color, p_retailprice AS price FROM part
    UNION ALL SELECT s_suppkey, NULL, s_name, NULL FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, NULL FROM customer""")
def _(t):
    return union_rows(
        t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")),
        t.supplier.select(F.col("s_suppkey").alias("product_id"), F.col("s_name").alias("color")),
        t.customer.select(F.col("c_custkey").alias("product_id"), F.col("c_name").alias("name")),
    )


@query("sl_01_sorted_ids", """
    SELECT DISTINCT CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) AS id FROM lineitem ORDER BY id""")
def _(t):
    ids = t.lineitem.select(F.concat_ws("_", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("id"))
    return sorted_ids(ids, "id")


@query("sl_02_trial_rows", """
    SELECT o_custkey AS catalog_id, o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2""")
def _(t):
    rows = t.orders.select(F.col("o_custkey").alias("catalog_id"), F.col("o_orderkey").alias("id"), "o_orderdate")
    first = first_rows(rows, ["catalog_id"], ["o_orderdate", "id"], 2)
    return first.select("catalog_id", "id", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("sl_02_trial_by_position", """
    SELECT o_custkey AS catalog_id, o_orderkey AS id,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS ord
    FROM orders QUALIFY ord < 2""")
def _(t):
    from catalogflow.operators.ordering import numbered

    rows = t.orders.select(F.col("o_custkey").alias("catalog_id"), F.col("o_orderkey").alias("id"))
    return cat.trial(numbered(rows, ["catalog_id"], ["id"], "ord"), 2)
