"""Image manifest, freshness and size check; pages stand for products with an image."""

from pyspark.sql import functions as F

from catalogflow.functions.urls import file_stem
from catalogflow.operators import assets
from fixture_queries.base import query

_SIZES = "(VALUES ('full', NULL, NULL), ('small', 50, 62)) AS s(size, box_width, box_height)"
_MANIFEST = f"""
    SELECT DISTINCT CAST(page_id AS VARCHAR) AS product_id, url, size, CAST(box_width AS VARCHAR) AS box_width,
           CAST(box_height AS VARCHAR) AS box_height, page_id || '/' || size || '/' || sha1(url) || '.jpg' AS key
    FROM pages, {_SIZES}"""


def page_images(t):
    """Every page's image URL, listed twice."""
    rows = t.pages.select(F.col("page_id").cast("string").alias("product_id"), "url")
    return rows.unionAll(rows)


@query("im_01_manifest", _MANIFEST)
def _(t):
    rows = assets.manifest(page_images(t), {"small": (50, 62)})
    return rows.withColumns({c: F.col(c).cast("string") for c in ("box_width", "box_height")})


@query("im_01_manifest_by_name", """
    SELECT CAST(page_id AS VARCHAR) AS product_id, url, 'full' AS size,
           page_id || '/full/' || string_split(string_split(url, '/')[-1], '.')[1] || '.jpg' AS key
    FROM pages""")
def _(t):
    return assets.manifest(page_images(t), name=file_stem).drop("box_width", "box_height")


@query("im_02_stale_assets", f"""
    WITH m AS ({_MANIFEST}), st AS (SELECT CAST(event_id AS VARCHAR) AS product_id, ts FROM events),
         l AS (SELECT m.*, ts AS stored_at FROM m LEFT JOIN st USING (product_id))
    SELECT key, coalesce(date_diff('day', CAST(stored_at AS DATE), DATE '2024-02-10'), -1) AS age_days FROM l
    WHERE age_days = -1 OR age_days >= 30""")
def _(t):
    full = assets.manifest(page_images(t), {"small": (50, 62)})
    stored = t.events.select(F.col("event_id").cast("string").alias("product_id"), F.col("ts").alias("stored_at"))
    known = full.select("product_id", "key").join(stored, "product_id").select("key", "stored_at")
    run_date = F.lit("2024-02-10").cast("date")
    age = F.coalesce(F.datediff(run_date, "stored_at").cast("bigint"), F.lit(-1).cast("bigint"))
    return assets.stale(full, known, run_date, 30).select("key", age.alias("age_days"))


@query("im_03_size_check", """
    SELECT p_partkey, p_name AS url, p_size AS width, CAST(floor(p_retailprice) AS INTEGER) AS height,
           CASE WHEN p_size < 25 OR CAST(floor(p_retailprice) AS INTEGER) < 1000
                THEN 'Image too small (' || p_size || 'x' || CAST(floor(p_retailprice) AS INTEGER) || ' < 25x1000): ' || p_name END AS reason
    FROM part""")
def _(t):
    rows = t.part.select("p_partkey", F.col("p_name").alias("url"), F.col("p_size").alias("width"),
                         F.floor("p_retailprice").cast("int").alias("height"))
    return assets.size_check(rows, 25, 1000)
