"""A vendor feed run: the catalogue names ids, the feed supplies the products."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogflow.operators import feed as shaping, matching
from catalogflow.operators.joins import join_reduced
from catalogflow.session import staged
from catalogflow.sources import feed_store, reports
from catalogflow.sources.vendor_feed import feed_items


@dataclass(frozen=True)
class FeedTables:
    """Updates, statuses, the rows that the feed lacks and the report of a feed run."""

    updates: DataFrame
    statuses: DataFrame
    not_found: DataFrame
    report: DataFrame


def tables(feed: DataFrame, catalog: DataFrame, base: str = "", store: str = "images", label: str | None = None) -> FeedTables:
    """Items of the feed records the catalogue lists, and the status of every catalogue row.

    The feed is cut by the semi-join before any text is decoded. With a ``label`` these records and the statuses are written
    once, so the XML is parsed once for all outputs. With a column ``catalog_id`` an item belongs to each catalogue that lists
    its id, and every catalogue has a report of its own.
    """
    listed = matching.in_catalog(feed, catalog, "Id")
    listed = listed if label is None else staged(listed, f"{label}/listed")
    statuses = matching.feed_status(catalog, listed, "Id")
    statuses = statuses if label is None else staged(statuses, f"{label}/statuses")
    updates, scope = feed_items(listed, base, store), []
    if "catalog_id" in catalog.columns:
        updates, scope = join_reduced(updates, catalog.select("catalog_id", "product_id").distinct(), ["product_id"]), ["catalog_id"]
    return FeedTables(updates, statuses, statuses.where(F.col("status") == "not_found"), matching.match_ratio(statuses, *scope))


def run(
    feed: DataFrame, catalog: DataFrame, out: str, run_id: str, properties: Sequence[shaping.Property] = (), base: str = "",
    store: str = "images", fmt: str = "parquet",
) -> FeedTables:
    """Write the feed version, the statuses, the ids not found and the reports of a vendor feed run below ``out``.

    A catalogue without a column ``catalog_id`` has one report, that of the catalogue ``all``.
    """
    result = tables(feed, catalog, base, store, label=f"feed-{run_id}-{uuid.uuid4().hex}")
    updates, deletes = shaping.update_and_delete(result.updates)
    of_catalogs = "catalog_id" in catalog.columns
    if of_catalogs:
        deletes = result.updates.where(F.coalesce("product_id", F.lit("")) != "").select("catalog_id", "product_id")
    declared = shaping.properties_table(feed.sparkSession, properties)
    feed_store.write_feed(f"{out}/feed", run_id, declared, deletes, updates, fmt, catalogs=catalog if of_catalogs else None)
    feed_store.write_table(result.statuses, f"{out}/statuses", run_id)
    feed_store.write_table(result.not_found, f"{out}/not_found", run_id)
    reports.write_reports(result.report if of_catalogs else result.report.withColumn("catalog_id", F.lit("all")), f"{out}/reports")
    return result
