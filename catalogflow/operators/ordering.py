"""Numbering and list building that hold when one key owns a third of all rows.

A window over such a key would sort the whole key in one task. Rows are therefore written once, which tells their size. In a table of
more than ``RANGE_BYTES``, keys that could hold more rows than one range are told from the others by counts of their hashes. The others are
numbered by a window. The large ones are dealt by range over key, order and a hash of all columns, so that every key is cut where it is large,
whatever its order column looks like. Each range is one sorted file: a row's number is its place in the file, less that of the first row of its
key there, plus the counts of the key in earlier files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalogflow.session import written

RANGE_BYTES = 64 << 20
GROUPS = 64  # hash groups of keys for each range


def split_large(rows: DataFrame, size: int, keys: Sequence[str], parts: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that fit one task, and those of the others, or none where all fit; ``rows`` is a written table of ``size`` bytes.

    Keys are counted in hash groups, of which there are ``GROUPS`` for each range of ``RANGE_BYTES``, so the counts are a small table
    however many keys there are. A group with more rows than a range counts as large; there are fewer of these than ranges.
    """
    parts = parts or -(-size // RANGE_BYTES)
    if parts <= 1:
        return rows, None
    group = F.pmod(F.xxhash64(*keys), F.lit(parts * GROUPS))
    counts = rows.groupBy(group.alias("_group")).agg(F.count("*").alias("_rows"))
    large = [r["_group"] for r in counts.where(F.col("_rows") > rows.count() / parts).collect()]
    return (rows.where(~group.isin(large)), rows.where(group.isin(large))) if large else (rows, None)


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "pos", start: int = 0, parts: int | None = None
) -> DataFrame:
    """Number the rows of each key from ``start`` in the given order; null keys are a key, null order values come first.

    ``df`` is evaluated once and written to the shared folder. Only rows that are equal in every column stay in one range for
    certain. ``parts`` sets the number of ranges; otherwise it follows the size.
    """
    rows, size = written(df, "numbered")
    return numbered_rows(rows, size, keys, order, name, start, parts)


def numbered_rows(
    rows: DataFrame, size: int, keys: Sequence[str], order: Sequence[str], name: str = "pos", start: int = 0, parts: int | None = None
) -> DataFrame:
    """:func:`numbered` over a written table of ``size`` bytes."""
    by = [*keys, *order, F.xxhash64(*rows.columns)]
    parts = parts or -(-size // RANGE_BYTES)
    small, large = split_large(rows, size, keys, parts)
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*by[len(keys):]))
    small = small.withColumn(name, (number - 1 + start).cast("bigint"))
    return small if large is None else small.unionByName(_ranged(large, keys, by, name, start, parts))


def _ranged(rows: DataFrame, keys: Sequence[str], by: Sequence, name: str, start: int, parts: int) -> DataFrame:
    """Rows numbered by their places in ``parts`` sorted files."""
    ranged, _ = written(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by), "ranged")
    file = F.regexp_extract_all("_metadata.file_name", F.lit("^part-([0-9]+)|-c([0-9]+)[.]"), F.lit(0))
    digits = F.transform(file, lambda x: F.regexp_replace(x, "[^0-9]", "").cast("bigint"))
    placed = ranged.select("*", (F.get(digits, F.lit(0)) * 1_000_000 + F.get(digits, F.lit(1))).alias("_file"), F.col("_metadata.row_index").alias("_at"))

    split = [*keys, "_file"]
    before = Window.partitionBy(*keys).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*split).agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    offsets = sizes.select(*[F.col(k).alias(f"_at_{i}") for i, k in enumerate(split)], (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = F.lit(True)
    for i, k in enumerate(split):
        same = same & placed[k].eqNullSafe(offsets[f"_at_{i}"])
    position = F.col("_at") + F.col("_shift") + start
    return placed.join(offsets, same).withColumn(name, position.cast("bigint")).select(*rows.columns, name)


def list_rows(df: DataFrame, key: str, value: str, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Values of each key as an ordered list in long form: ``(key, pos, value)``, repeats kept."""
    columns = dict.fromkeys([key, value, *order])
    return numbered(df.select(*columns), [key], order, parts=parts).select(key, "pos", value)


def list_pieces(rows: DataFrame, key: str, value: str, size: int = 1000) -> DataFrame:
    """Long lists packed into arrays of at most ``size`` values: ``(key, piece, values)``.

    A list is never held in one row, so a key with very many values stays spread over tasks.
    """
    pieces = rows.groupBy(key, F.floor(F.col("pos") / size).alias("piece")).agg(
        F.array_sort(F.collect_list(F.struct("pos", value))).alias("_sorted")
    )
    return pieces.select(key, "piece", F.transform("_sorted", lambda x: x[value]).alias("values"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: int = 1) -> DataFrame:
    """The first ``count`` rows of each key.

    Spark limits each group before the shuffle (window group limit), so a hot key sends at most
    ``count`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= count).drop("_rank")


def sorted_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows in ascending order (bytewise for text)."""
    return df.select(*columns).distinct().orderBy(*columns)
