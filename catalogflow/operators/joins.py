"""Joins of many rows with a table that has one row per key, when one key may own a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_reduced(rows: DataFrame, reduced: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``reduced``, which an aggregation or window has cut to one row per key.

    Spark's skew join splits a hot key only if both sides come straight from the join's own shuffle. An
    aggregated side is already placed by key and would be taken as it is, leaving the hot key to one task. A hash of the
    keys as one more join column makes Spark shuffle the (small) reduced side too, so the split works. When the
    reduced side is small enough to broadcast, Spark still does so from its run-time size.
    """
    tag = F.xxhash64(*keys).alias("_tag")
    left, right = rows.select("*", tag), reduced.select("*", tag)
    return left.join(right, [*keys, "_tag"], how).drop("_tag")
