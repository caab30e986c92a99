"""Vendor feeds, declared properties, typed fields and written feeds."""

import uuid

from pyspark.sql import functions as F

from catalogflow.operators import feed
from catalogflow.operators.feed import Property
from catalogflow.plans import feed_run
from catalogflow.session import shared_folder
from catalogflow.sources import documents, feed_store, vendor_feed
from fixture_queries.base import query

_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)"


def vendor_records(t):
    """Parts as records of a vendor feed; some lack a description or an image."""
    price = F.col("p_retailprice").cast("decimal(18,4)").cast("string")
    return t.part.select(
        F.col("p_partkey").cast("string").alias("Id"), F.col("p_name").alias("EngName"),
        F.when(F.col("p_type") != "PROMO", F.concat("p_name", F.lit(" &amp;amp; "), "p_brand")).alias("EngLongDesc"),
        price.alias("RetailPrice"), F.col("p_brand").alias("PartNumber"), F.col("p_size").cast("string").alias("MaxQty"),
        F.when(F.col("p_size") < 10, "0").otherwise("1").alias("IsActive"),
        F.when(F.col("p_type") != "SMALL", F.concat(F.lit("img/"), F.col("p_partkey").cast("string"))).alias("ImagePath_Large"),
        F.when(F.col("p_type") == "LARGE", F.concat(F.lit("alt/"), F.col("p_partkey").cast("string"))).alias("Alternate1ImagePath_Large"),
    )


@query("src_04_vendor_feed", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name_english, {_PRICE} AS custom_price,
           CASE WHEN p_type <> 'PROMO' THEN '<![CDATA[' || p_name || ' & ' || p_brand || ']]>' END AS description_english,
           CASE WHEN p_size < 10 THEN 'NOT_IN_STOCK' ELSE 'IN_STOCK' END AS in_stock, CAST(NULL AS VARCHAR) AS name_spanish,
           concat_ws(' ', CASE WHEN p_type <> 'SMALL' THEN 'http://vendor.invalid/img/' || p_partkey END,
                     CASE WHEN p_type = 'LARGE' THEN 'http://vendor.invalid/alt/' || p_partkey END) AS image_urls
    FROM part""")
def _(t):
    xml = vendor_records(t).select(F.to_xml(F.struct("*"), {"rowTag": "properties"}).alias("xml"))
    parsed = xml.select(vendor_feed.parse_record(F.col("xml")).alias("r")).select("r.*")
    items = vendor_feed.feed_items(parsed, "http://vendor.invalid/")
    return items.select(
        "product_id", "name_english", "custom_price", "description_english", "in_stock", "name_spanish",
        F.array_join("image_urls", " ").alias("image_urls"),
    )


@query("src_04_vendor_feed_file", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name_english, {_PRICE} AS custom_price,
           CASE WHEN p_type <> 'SMALL' THEN 'images/full/' || sha1('http://vendor.invalid/img/' || p_partkey) || '.jpg' ELSE '' END
           || CASE WHEN p_type = 'LARGE' THEN ' images/full/' || sha1('http://vendor.invalid/alt/' || p_partkey) || '.jpg' ELSE '' END
           AS images
    FROM part""")
def _(t):
    path = f"{shared_folder(t.spark)}/vendor-{uuid.uuid4().hex}"
    records = vendor_records(t)
    plain = F.to_xml(F.struct(*records.columns), {"rowTag": "properties"})
    prefixed = F.replace(F.regexp_replace(plain, "<(/?)", "<$1d:"), F.lit("d:properties"), F.lit(vendor_feed.ROW_TAG))
    # One feed file holds the records of 10,000 consecutive ids.
    files = records.select(F.floor(F.col("Id").cast("bigint") / 10_000).alias("file"), prefixed.alias("x")).groupBy("file")
    body = F.concat(F.lit('<feed xmlns:m="urn:m" xmlns:d="urn:d">'), F.array_join(F.collect_list("x"), "\n"), F.lit("</feed>"))
    files.agg(body.alias("value")).write.partitionBy("file").mode("overwrite").text(path)
    items = vendor_feed.feed_items(vendor_feed.read_feed(t.spark, path), "http://vendor.invalid/")
    return items.select("product_id", "name_english", "custom_price", F.array_join("normal_image_url", " ").alias("images"))


# Parts of all order lines, every seventh shifted to one that the feed lacks.
_LISTED = "SELECT CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END FROM lineitem"


@query("run_vendor_feed", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name_english, {_PRICE} AS custom_price,
           CASE WHEN p_size < 10 THEN 'NOT_IN_STOCK' ELSE 'IN_STOCK' END AS in_stock
    FROM part WHERE p_partkey IN ({_LISTED})""")
def _(t):
    key = F.col("l_partkey")
    listed = t.lineitem.select(F.when(key % 7 == 0, key + 1_000_000_000).otherwise(key).cast("string").alias("product_id"))
    full = vendor_records(t)
    records = full.select(*[F.col(f) if f in full.columns else F.lit(None).cast("string").alias(f) for f in vendor_feed.FIELDS])
    return feed_run.tables(records, listed).updates.select("product_id", "name_english", "custom_price", "in_stock")


@query("run_feed_report", """
    WITH c AS (SELECT DISTINCT l_returnflag AS catalog_id, CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS k FROM lineitem),
         s AS (SELECT catalog_id, CAST(k AS VARCHAR) AS product_id, k IN (SELECT p_partkey FROM part) AS found FROM c)
    SELECT 'not_found' AS part, catalog_id, product_id, CAST(NULL AS VARCHAR) AS message FROM s WHERE NOT found
    UNION ALL SELECT 'update', catalog_id, product_id, NULL FROM s WHERE found
    UNION ALL SELECT 'report', catalog_id, NULL, CASE WHEN count(*) FILTER (NOT found) > 0
        THEN count(*) FILTER (NOT found) || ' id(s) from id list weren''t found in feed' ELSE 'All ids found in feed.' END
    FROM s GROUP BY catalog_id""")
def _(t):
    out = f"{shared_folder(t.spark)}/run-{uuid.uuid4().hex}"
    key = F.col("l_partkey")
    catalogs = t.lineitem.select(
        F.col("l_returnflag").alias("catalog_id"), F.when(key % 7 == 0, key + 1_000_000_000).otherwise(key).cast("string").alias("product_id")).distinct()
    full = vendor_records(t)
    records = full.select(*[F.col(f) if f in full.columns else F.lit(None).cast("string").alias(f) for f in vendor_feed.FIELDS])
    feed_run.run(records, catalogs, out, "1")
    message = F.lit(None).cast("string").alias("message")
    missing = t.spark.read.parquet(f"{out}/not_found").select(F.lit("not_found").alias("part"), "catalog_id", "product_id", message)
    updates = feed_store.read_catalogs(t.spark, f"{out}/feed", "update").select(F.lit("update").alias("part"), "catalog_id", "product_id", message)
    reports = t.spark.read.schema("value string, catalog_id string").text(f"{out}/reports", wholetext=True).select(
        F.lit("report").alias("part"), "catalog_id", F.lit(None).cast("string").alias("product_id"), F.regexp_replace("value", "\n$", "").alias("message"))
    return missing.unionAll(updates).unionAll(reports)


@query("snk_01_single_document", """
    SELECT 'update' AS part, CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, CASE WHEN p_size > 10 THEN '<' || p_brand || '&>' END AS brand FROM part
    UNION ALL SELECT 'delete', CAST(p_partkey AS VARCHAR), NULL, NULL FROM part
    UNION ALL SELECT 'properties', * FROM (VALUES ('brand', 'Brand', 'text'), ('size', 'Size', 'integer'))""")
def _(t):
    path = f"{shared_folder(t.spark)}/export-{uuid.uuid4().hex}.xml"
    brand = F.when(F.col("p_size") > 10, F.concat(F.lit("<"), "p_brand", F.lit("&>"))).alias("brand")
    updates = t.part.select(F.col("p_partkey").cast("string").alias("product_id"), F.col("p_name").alias("name"), brand)
    declared = feed.properties_table(t.spark, [Property("brand", "Brand"), Property("size", "Size", "integer")])
    documents.write_document(path, declared, updates.select("product_id"), updates, order=["product_id"])
    none = F.lit(None).cast("string")
    read = documents.read_document(t.spark, path, "update", updates.schema).select(F.lit("update").alias("part"), "product_id", "name", "brand")
    gone = documents.read_document(t.spark, path, "delete").select(F.lit("delete").alias("part"), "product_id", none.alias("name"), none.alias("brand"))
    return read.unionAll(gone).unionAll(documents.read_document(t.spark, path, "properties").select(F.lit("properties"), "*"))


PROPERTIES = (
    Property("brand", "Brand", "text"), Property("price", "Price", "decimal"), Property("size", "Size", "integer"),
    Property("on_sale", "On Sale", "boolean"),
)
_BROKEN = "p_type = 'PROMO'"


def raw_items(t):
    """Parts as untyped items; one type of part carries values that do not cast."""
    broken = F.col("p_type") == "PROMO"
    return t.part.select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_brand").alias("brand"),
        F.when(broken, "call us").otherwise(F.concat(F.lit("1,"), F.col("p_retailprice").cast("string"))).alias("price"),
        F.when(broken, "one size").otherwise(F.concat(F.lit(" "), F.col("p_size").cast("string"))).alias("size"),
        F.when(F.col("p_size") > 25, "True").when(F.col("p_size") > 5, "False").alias("on_sale"),
    )


_TABLE_SQL = """(VALUES ('brand', 'Brand', 'text'), ('price', 'Price', 'decimal'), ('size', 'Size', 'integer'),
                 ('on_sale', 'On Sale', 'boolean')) AS d(identifier, display_name, value_type)"""


@query("sc_01_properties", f"""
    SELECT identifier, display_name, value_type,
           CASE identifier WHEN 'on_sale' THEN (SELECT count(*) FROM part WHERE p_size > 5) ELSE (SELECT count(*) FROM part) END
           AS n_values,
           CASE value_type WHEN 'decimal' THEN 'decimal(18,2)' WHEN 'integer' THEN 'bigint' WHEN 'text' THEN 'string'
                ELSE value_type END AS spark_type
    FROM {_TABLE_SQL}""")
def _(t):
    declared = feed.properties_table(t.spark, PROPERTIES)
    rows = feed.long_rows(raw_items(t), [p.identifier for p in PROPERTIES])
    counts = rows.groupBy("field").agg(F.count("*").alias("n_values"))
    types = F.create_map(*[F.lit(x) for f in feed.properties_schema(PROPERTIES) for x in (f.name, f.dataType.simpleString())])
    return declared.join(counts, F.col("identifier") == F.col("field")).drop("field").withColumn("spark_type", types[F.col("identifier")])


@query("sc_02_typed_view", f"""
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS brand,
           CASE WHEN NOT {_BROKEN} THEN CAST('1' || CAST(p_retailprice AS VARCHAR) AS DOUBLE) END AS price,
           CASE WHEN NOT {_BROKEN} THEN CAST(p_size AS BIGINT) ELSE -1 END AS size,
           CAST(CASE WHEN p_size > 5 THEN p_size > 25 END AS VARCHAR) AS on_sale
    FROM part""")
def _(t):
    return feed.typed_view(raw_items(t), PROPERTIES).select(
        "product_id", "brand", F.col("price").cast("double").alias("price"),
        F.coalesce("size", F.lit(-1).cast("bigint")).alias("size"), F.col("on_sale").cast("string").alias("on_sale"))


@query("sc_02_cast_failures", f"""
    SELECT 'brand' AS field, count(*) AS n_values, CAST(0 AS BIGINT) AS n_failed FROM part
    UNION ALL SELECT 'price', count(*), count(*) FILTER ({_BROKEN}) FROM part
    UNION ALL SELECT 'size', count(*), count(*) FILTER ({_BROKEN}) FROM part
    UNION ALL SELECT 'on_sale', count(*) FILTER (p_size > 5), 0 FROM part""")
def _(t):
    return feed.cast_failures(raw_items(t), PROPERTIES)


@query("sc_04_updates_and_deletes", """
    SELECT 'update' AS part, CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS brand FROM part
    UNION ALL SELECT 'delete', CAST(p_partkey AS VARCHAR), NULL FROM part""")
def _(t):
    updates, deletes = feed.update_and_delete(raw_items(t))
    rows = updates.select(F.lit("update").alias("part"), "product_id", "brand")
    return rows.unionByName(deletes.withColumn("part", F.lit("delete")), allowMissingColumns=True)


def _written(t, versions, fmt="parquet"):
    path = f"{shared_folder(t.spark)}/feed-{uuid.uuid4().hex}"
    declared = feed.properties_table(t.spark, PROPERTIES)
    for version, items in versions.items():
        updates, deletes = feed.update_and_delete(items)
        feed_store.write_feed(path, version, declared, deletes, updates, fmt)
    return path


_RAW_SQL = f"""SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_brand AS brand,
           CASE WHEN {_BROKEN} THEN 'call us' ELSE '1,' || CAST(p_retailprice AS VARCHAR) END AS price,
           CASE WHEN p_size > 25 THEN 'True' WHEN p_size > 5 THEN 'False' END AS on_sale, 'update' AS part
    FROM part"""


@query("snk_01_feed_xml", f"""
    {_RAW_SQL} UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, NULL, 'delete' FROM part
    UNION ALL SELECT identifier, display_name, value_type, NULL, 'properties' FROM {_TABLE_SQL}""")
def _(t):
    path = _written(t, {"1": raw_items(t)}, fmt="xml") + "/version=1"
    read = lambda part, schema: t.spark.read.format("xml").option("rowTag", feed_store.ROW_TAGS[part]).schema(schema).load(f"{path}/{part}")
    updates = read("update", "product_id string, brand string, price string, on_sale string").withColumn("part", F.lit("update"))
    deletes = read("delete", "_VALUE string").select(F.col("_VALUE").alias("product_id"), F.lit("delete").alias("part"))
    declared = read("properties", "`_identifier` string, `_display-name` string, `_value-type` string").select(
        F.col("_identifier").alias("product_id"), F.col("`_display-name`").alias("brand"), F.col("`_value-type`").alias("price"),
        F.lit("properties").alias("part"))
    return updates.unionByName(deletes, allowMissingColumns=True).unionByName(declared, allowMissingColumns=True)


@query("snk_02_feed_versions", """
    SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'current' AS version, '2,3' AS kept FROM part
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'previous', '2,3' FROM part WHERE p_type <> 'PROMO'""")
def _(t):
    items = raw_items(t)
    fewer = items.where(F.col("price") != "call us")
    path = _written(t, {"1": items.where(F.col("price") == "call us"), "2": fewer, "3": items})
    kept = F.lit(",".join(feed_store.versions(t.spark, path))).alias("kept")
    pick = lambda back, label: feed_store.read_feed(t.spark, path, "update", back).select("product_id", F.lit(label).alias("version"), kept)
    return pick(0, "current").unionAll(pick(1, "previous"))
