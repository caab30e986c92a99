"""Catalogues kept as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRODUCT_COLUMNS = ("id", "name", "url", "product_id", "status")


def select_catalog(products: DataFrame, catalog_id: int | None = None, row_id: int | None = None) -> DataFrame:
    """Rows of one catalogue, or the single row ``row_id``, which overrides it.

    Both filter and columns reach the scan.
    """
    chosen = F.col("id") == row_id if row_id is not None else F.col("catalog_id") == catalog_id
    return products.where(chosen).select(*PRODUCT_COLUMNS)


def catalog_info(catalogs: DataFrame, catalog_id: int | None = None) -> DataFrame:
    """File and display name by catalogue id, for one catalogue or all."""
    rows = catalogs if catalog_id is None else catalogs.where(F.col("id") == catalog_id)
    return rows.select(F.col("id").alias("catalog_id"), "name", "file")


def read_jdbc(
    spark: SparkSession, url: str, table: str, low: int, high: int, partitions: int,
    partition_column: str = "id", **properties: str,
) -> DataFrame:
    """A catalogue table over JDBC, read in parallel by ranges of its row id."""
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions,
        properties=properties,
    )
