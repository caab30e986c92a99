"""Vendor product feeds in XML: one ``properties`` element per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogflow.functions.prices import drop_last, stock_flag
from catalogflow.functions.text import cdata, decode_entities
from catalogflow.functions.urls import absolute_each, asset_path

# Element names of a feed record, its namespace prefixes, and its row element.
FIELDS = (
    "Id", "EngName", "SpnName", "EngLongDesc", "SpnLongDesc", "RetailPrice", "PartNumber", "MaxQty", "TimeType",
    "IsActive", "ImagePath_Large", "Alternate1ImagePath_Large", "Alternate2ImagePath_Large", "Alternate3ImagePath_Large",
)
PREFIX, ROW_TAG = "d:", "m:properties"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Records of a feed file; elements that are absent are null."""
    schema = ", ".join(f"`{PREFIX}{f}` string" for f in FIELDS)
    rows = spark.read.format("xml").option("rowTag", ROW_TAG).schema(schema).load(path)
    return rows.select(*[F.col(f"`{PREFIX}{f}`").alias(f) for f in FIELDS])


def parse_record(xml: Column) -> Column:
    """A record held as a text column, as a struct of the feed's fields."""
    schema = ", ".join(f"{f} string" for f in FIELDS)
    return F.from_xml(xml, schema)


def feed_items(feed: DataFrame, base: str = "", store: str = "images") -> DataFrame:
    """Feed records as items: renamed fields, stored image paths, stock value; absent fields stay null."""
    images = F.filter(
        F.array(*[F.col(f) for f in FIELDS if f.endswith("ImagePath_Large")]), lambda i: i.isNotNull()
    )
    urls = absolute_each(base, images)
    return feed.select(
        F.col("Id").alias("product_id"),
        F.col("EngName").alias("name_english"),
        F.col("SpnName").alias("name_spanish"),
        decode_entities(cdata(F.col("EngLongDesc"))).alias("description_english"),
        decode_entities(cdata(F.col("SpnLongDesc"))).alias("description_spanish"),
        drop_last(F.col("RetailPrice")).alias("custom_price"),
        F.col("PartNumber").alias("add_to_cart_id"),
        F.col("MaxQty").alias("max_qty"),
        F.col("TimeType").alias("time_type"),
        stock_flag(F.col("IsActive")).alias("in_stock"),
        F.transform(urls, lambda u: asset_path(store, u)).alias("normal_image_url"),
        urls.alias("image_urls"),
    )
