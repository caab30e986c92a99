"""Manifest of product images: which to store, where, in which sizes, and which to skip."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalogflow.functions.urls import product_asset_path


def manifest(
    images: DataFrame, thumbs: Mapping[str, tuple[int, int]] | None = None,
    name: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row per distinct product and image URL and per size, with its target key.

    ``images`` holds ``(product_id, url)``. ``thumbs`` maps a size name to its box; ``full`` is always present.
    Names default to the hash of the URL.
    """
    stem = name(F.col("url")) if name else F.sha1(F.col("url").cast("binary"))
    sizes = [("full", None, None), *[(size, w, h) for size, (w, h) in (thumbs or {}).items()]]
    boxes = F.array(*[
        F.struct(F.lit(s).alias("size"), F.lit(w).cast("int").alias("box_width"), F.lit(h).cast("int").alias("box_height"))
        for s, w, h in sizes
    ])
    distinct = images.select("product_id", "url").where(F.coalesce("url", F.lit("")) != "").distinct()
    return distinct.select("*", F.inline(boxes)).withColumn(
        "key", product_asset_path(F.col("product_id"), stem, F.col("size"))
    )


def stale(assets: DataFrame, stored: DataFrame, run_date: Column, days: int, key: str = "key") -> DataFrame:
    """Assets never stored, or stored at least ``days`` days before the run; fresh ones are skipped."""
    latest = stored.groupBy(key).agg(F.max("stored_at").alias("stored_at"))
    joined = assets.join(latest, key, "left")
    return joined.where(F.col("stored_at").isNull() | (F.datediff(run_date, "stored_at") >= days))


def size_check(assets: DataFrame, min_width: int, min_height: int) -> DataFrame:
    """Add the reason for images below the minimum size; null means accepted."""
    small = (F.col("width") < min_width) | (F.col("height") < min_height)
    reason = F.format_string(
        "Image too small (%dx%d < %dx%d): %s",
        F.col("width"), F.col("height"), F.lit(min_width), F.lit(min_height), F.col("url"),
    )
    return assets.withColumn("reason", F.when(small, reason))
