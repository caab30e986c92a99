"""The text functions for SQL users, as temporary SQL functions that Spark inlines into the plan."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Name and parameters, result type, and the expression.
FUNCTIONS = {
    "text_between(s STRING, first STRING, last STRING)": (
        "ARRAY<STRING>",
        "transform(slice(split(s, concat('\\\\Q', first, '\\\\E')), 2, 1000000000), p -> substring_index(p, last, 1))",
    ),
    "text_plain(s STRING)": ("STRING", "regexp_replace(translate(s, '\\r\\n\\t', ''), '(?d)<.*?>', '')"),
    "price_text(s STRING)": ("STRING", "regexp_replace(s, '[^0-9,.]+', '')"),
    "price_value(s STRING)": ("DECIMAL(18,2)", "try_cast(regexp_replace(s, '[^0-9.]+', '') AS DECIMAL(18,2))"),
    "loyalty_points(s STRING)": ("BIGINT", "cast(try_cast(s AS DOUBLE) * 100 AS BIGINT)"),
    "asset_path(store STRING, url STRING)": ("STRING", "concat(store, '/full/', sha1(url), '.jpg')"),
    "root_id(id STRING)": ("STRING", "substring_index(id, '_', 1)"),
}


def register(spark: SparkSession) -> None:
    """Make the functions available to the SQL of a session."""
    for head, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
