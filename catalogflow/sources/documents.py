"""A whole product feed as one XML document: properties, delete list and updates, in this order.

Rows become lines of text in Spark tasks; the part files are then joined by streams on the file system. An element of a product
is indented, so a line that begins with ``<product_id>`` is a row of the delete list, which can be read without the products.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogflow.sources import files
from catalogflow.sources.feed_store import PARTS, ROW_TAGS

ROOT = "products"
ATTRIBUTES = {"identifier": "_identifier", "display_name": "_display-name", "value_type": "_value-type"}


def _lines(part: str, df: DataFrame) -> Column:
    """Rows of a part as elements; null fields are left out."""
    if part == "properties":
        row = F.struct(*[F.col(c).alias(a) for c, a in ATTRIBUTES.items()])
    elif part == "delete":
        row = F.struct(F.col("product_id").cast("string").alias("_VALUE"))
    else:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return F.to_xml(row, {"rowTag": ROW_TAGS[part]})


def write_document(
    path: str, properties: DataFrame, deletes: DataFrame, updates: DataFrame, order: Sequence[str] = (), namespace: str = "",
) -> None:
    """Write a feed to the file ``path``; the file that was there stays as ``<name>_backup<ending>``.

    With ``order`` the updates and deletes are in the order of these columns (those that each has), otherwise as they come. Empty parts
    are empty elements; a delete row without an id is left out.
    """
    spark = updates.sparkSession
    work = f"{path}.{uuid.uuid4().hex}.parts"
    attribute = f' xmlns="{namespace}"' if namespace else ""
    pieces: list = [f'<?xml version="1.0" encoding="UTF-8"?>\n<{ROOT}{attribute}>\n']
    deletes = deletes.where(F.coalesce("product_id", F.lit("")) != "")
    for part, df in zip(PARTS, (properties, deletes, updates), strict=True):
        by = [c for c in order if c in df.columns]
        if by and part != "properties":
            df = df.repartitionByRange(*by).sortWithinPartitions(*by)
        df.select(_lines(part, df).alias("value")).write.option("lineSep", "\n").text(f"{work}/{part}")
        pieces += [f"<{part}>\n", (f"{work}/{part}",), f"</{part}>\n"]
    stem, dot, ending = path.rpartition(".")
    backup = f"{stem}_backup.{ending}" if dot and "/" not in ending else f"{path}_backup"
    files.join_files(spark, path, [*pieces, f"</{ROOT}>\n"], backup)
    files.remove(spark, work)


def read_document(spark: SparkSession, path: str, part: str, schema: str | T.StructType | None = None) -> DataFrame:
    """A part of a document that :func:`write_document` wrote; ``schema`` names the fields of the updates."""
    if part == "delete":
        lines = spark.read.text(path).where(F.col("value").startswith(f"<{ROW_TAGS[part]}>"))
        return lines.select(F.from_xml(F.concat(F.lit("<row>"), "value", F.lit("</row>")), "product_id string").alias("r")).select("r.*")
    reader = spark.read.format("xml").option("rowTag", ROW_TAGS[part])
    if part == "properties":
        rows = reader.schema(", ".join(f"`{a}` string" for a in ATTRIBUTES.values())).load(path)
        return rows.select(*[F.col(f"`{a}`").alias(c) for c, a in ATTRIBUTES.items()])
    if schema is None:
        raise ValueError("the schema of the updates is needed")
    return reader.schema(schema).load(path)
