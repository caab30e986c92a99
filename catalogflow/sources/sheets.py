"""Catalogue sheets exported as parquet or CSV.

A CSV file is read by byte ranges like any text, so that a sheet of any size takes several tasks. Where a range begins inside a quoted
cell, or how many records lie before it, is known once the quotes and records of the ranges before it are counted; only those
counts, one row for each range, meet. Records of one line stay where they are, the few with line breaks in a cell are put together.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalogflow.operators.catalog import NO_URL, normal_id, normal_url
from catalogflow.operators.joins import join_reduced
from catalogflow.session import staged
from catalogflow.sources import files

LONGEST = 10_000  # lines of one record; more are a quote that was never closed
TASK_BYTES = 4 << 20  # read by a task where the byte ranges are smaller
LINE_SCHEMA = "file string, sheet string, block long, line long, value string, quotes int, odd int, ends_outside long, ends_inside long"

# The code and the message of a sheet that cannot be read.
UNREADABLE = 103
UNREADABLE_TEXT = "Error reading excel file\nError occurred for given file: %s"


@dataclass(frozen=True)
class Layout:
    """Header rows and the position of each column; ``optional`` ones may be absent."""

    header_rows: int
    columns: dict[str, int]
    optional: tuple[str, ...] = ()
    float_ids: bool = False


# Header rows and column positions of the known sheet layouts.
DEFAULT = Layout(15, {"product_id": 1, "name": 2, "url": 3})
COMPACT = Layout(2, {"product_id": 0, "name": 1, "url": 2})
BUNDLE = Layout(1, {"product_id": 0, "look_id": 1, "line_id": 2, "url": 4, "order_index": 6}, ("order_index",))
LOOKS = Layout(1, {"product_id": 0, "name": 1, "url": 2})
LINES = Layout(1, {"product_id": 0, "name": 1})


def parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """Cells of an exported sheet as ``_c0, _c1, ...`` with the row position in its file."""
    df = spark.read.parquet(path)
    cells = [F.col(f"`{name}`").alias(f"_c{n}") for n, name in enumerate(df.columns)]
    meta = F.col("_metadata")
    return df.select(*cells, meta["row_index"].alias("row"), meta["file_name"].alias("sheet"), meta["file_path"].alias("file"))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their number in the byte range, and what the range's lines before them hold: whether their quotes are odd, and the records
    that end there if the range begins outside or inside a quoted cell."""
    at, line, odd, outside, inside = None, 0, 0, 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy(zero_copy_only=False)
        quotes = pc.count_substring(batch.column("value"), '"').to_numpy(zero_copy_only=False) % 2
        other = (block[1:] != block[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for first, last in zip(edges[:-1], edges[1:], strict=True):
            if at != (here := (file[first].as_py(), int(block[first]))):
                at, line, odd, outside, inside = here, 0, 0, 0, 0
            after = (odd + np.cumsum(quotes[first:last])) % 2
            closed = np.cumsum(after == 0)
            count = np.arange(1, last - first + 1)
            columns[0].append(line + count - 1)
            columns[1].append(np.concatenate([[odd], after[:-1]]))
            columns[2].append(outside + np.concatenate([[0], closed[:-1]]))
            columns[3].append(inside + np.concatenate([[0], (count - closed)[:-1]]))
            line, odd, outside, inside = line + last - first, int(after[-1]), outside + int(closed[-1]), inside + int(count[-1] - closed[-1])
        number, before, ends_outside, ends_inside = (np.concatenate(c) for c in columns)
        yield pa.RecordBatch.from_arrays([
            file, batch.column("sheet"), batch.column("block"), pa.array(number, pa.int64()), batch.column("value"), pa.array(quotes, pa.int32()),
            pa.array(before, pa.int32()), pa.array(ends_outside, pa.int64()), pa.array(ends_inside, pa.int64())],
            names=[f.split()[0] for f in LINE_SCHEMA.split(", ")])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the sheets with the number of their record in the file, whether they begin inside a quoted cell, and whether the file ends so."""
    text = spark.read.option("lineSep", "\n").text(path)
    # ranges stay as they are read; small ones share tasks, whose number follows the bytes
    text = text.coalesce(max(4 * spark.sparkContext.defaultParallelism, -(-files.matched_size(spark, path) // TASK_BYTES)))
    scanned = text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("sheet"),
                          F.col("_metadata.file_block_start").alias("block")).mapInArrow(_scanned, LINE_SCHEMA)
    blocks = scanned.groupBy("file", "block").agg(
        (F.sum("quotes") % 2).alias("parity"), F.count_if((F.col("odd") + F.col("quotes")) % 2 == 0).alias("outside"), F.count("*").alias("lines"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    starts = blocks.withColumn("start", F.coalesce(F.sum("parity").over(before), none) % 2).withColumn(
        "ends", F.when(F.col("start") == 0, F.col("outside")).otherwise(F.col("lines") - F.col("outside")))
    starts = starts.select(
        "file", "block", "start", F.coalesce(F.sum("ends").over(before), none).alias("base"),
        (F.sum("parity").over(Window.partitionBy("file")) % 2 == 1).alias("unclosed"))
    placed = join_reduced(scanned, starts, ["file", "block"])
    return placed.select(
        "file", "sheet", "block", "line", "value", "quotes", "unclosed", ((F.col("start") + F.col("odd")) % 2 == 1).alias("inside"),
        (F.col("base") + F.when(F.col("start") == 0, F.col("ends_outside")).otherwise(F.col("ends_inside"))).alias("row"))


def csv_records(spark: SparkSession, path: str, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Records of exported CSV sheets ``(file, sheet, row, value)``, and the sheets that cannot be read ``(file, sheet, reason)``.

    Cells may hold line breaks inside quotes; a quote in a cell is written twice. A sheet whose last quote is not closed, or with
    a record of more than ``longest`` lines, is not read at all.
    """
    lines = staged(_lines(spark, path), f"sheet-lines-{uuid.uuid4().hex}")
    several = lines.where("NOT unclosed AND (inside OR quotes = 1)")
    sized = several.groupBy("file", "sheet", "row").agg(F.count("*").alias("n"))
    unclosed = lines.where("unclosed").select("file", "sheet").distinct().withColumn("reason", F.lit("a quote is not closed"))
    too_long = sized.where(F.col("n") > longest).select("file", "sheet").distinct().withColumn("reason", F.lit(f"a record has more than {longest} lines"))
    bad = unclosed.unionByName(too_long)
    whole = several.join(too_long.select("file"), "file", "left_anti").groupBy("file", "sheet", "row").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n").alias("value"))
    lone = lines.where("NOT unclosed AND NOT inside AND quotes = 0").join(too_long.select("file"), "file", "left_anti")
    records = lone.select("file", "sheet", "row", "value").unionByName(whole)
    bare = F.regexp_replace("value", "\r$", "")
    return records.withColumn("value", F.when(F.col("row") == 0, F.ltrim(bare, F.lit("\ufeff"))).otherwise(bare)), bad


def _cells(records: DataFrame, columns: int) -> DataFrame:
    """Cells of records as ``_c0, _c1, ...``."""
    schema = ", ".join(f"_c{n} string" for n in range(columns))
    parsed = records.withColumn("cells", F.from_csv("value", schema, {"escape": '"', "multiLine": "true"}))
    return parsed.select(*[F.col(f"cells._c{n}").alias(f"_c{n}") for n in range(columns)], "row", "sheet", "file")


def csv_rows(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """Cells of exported CSV sheets with the row position in each file, without the sheets that cannot be read."""
    return _cells(csv_records(spark, path)[0], columns)


def read_csv(spark: SparkSession, path: str, layout: Layout, read_rows=None) -> tuple[DataFrame, DataFrame]:
    """Catalogue rows of CSV sheets, and a report row ``(file, sheet, code, message, reason)`` for each sheet that cannot be read.

    Besides the reasons of :func:`csv_records`, a sheet of which no record has a column that the layout needs cannot be read.
    ``read_rows`` takes the place of :func:`apply_layout`.
    """
    records, bad = csv_records(spark, path)
    needed = {name: n for name, n in layout.columns.items() if name not in layout.optional}
    last = max(needed, key=needed.__getitem__)
    width = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ","))
    narrow = records.groupBy("file", "sheet").agg(F.max(width).alias("width")).where(F.col("width") <= needed[last]).select(
        "file", "sheet", F.lit(f"the sheet has no column {needed[last]} for {last}").alias("reason"))
    cells = _cells(records.join(narrow.select("file"), "file", "left_anti"), max(layout.columns.values()) + 1)
    problems = bad.unionByName(narrow).groupBy("file", "sheet").agg(F.min("reason").alias("reason")).select(
        "file", "sheet", F.lit(UNREADABLE).alias("code"), F.format_string(UNREADABLE_TEXT, "sheet").alias("message"), "reason")
    return (read_rows or apply_layout)(cells, layout), problems


def apply_layout(rows: DataFrame, layout: Layout, placeholder: str = NO_URL) -> DataFrame:
    """Catalogue rows of a sheet: header rows skipped, cells trimmed, ids and URLs normalised, ``ord`` from 0."""
    types = dict(rows.dtypes)
    out = []
    for name, position in layout.columns.items():
        cell = f"_c{position}"
        if cell not in types:
            if name not in layout.optional:
                raise ValueError(f"the sheet has no column {position} for {name}")
            continue
        c = F.col(cell)
        if name == "product_id":
            out.append(normal_id(c, layout.float_ids or types[cell] in ("double", "float")).alias(name))
        elif name == "url":
            out.append(normal_url(F.coalesce(c, F.lit("")), placeholder).alias(name))
        else:
            out.append(F.trim(c.cast("string")).alias(name))
    kept = [c for c in rows.columns if not c.startswith("_c") and c != "row"]
    body = rows.where(F.col("row") >= layout.header_rows)
    return body.select(*kept, *out, (F.col("row") - layout.header_rows).alias("ord"))
