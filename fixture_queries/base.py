"""Registry of queries and short access to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The given tables of one scale as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name, with its SQL when there is one."""

    def add(f):
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def sha(c: Column) -> Column:
    """Hash of a text, to compare long texts by a short value."""
    return F.sha1(c.cast("binary"))


def size(c: Column) -> Column:
    """Length of a text as bigint."""
    return F.length(c).cast("bigint")


def line_ord() -> Column:
    """Position of an order line: dense in the order key."""
    return F.col("l_orderkey") * 8 + F.col("l_linenumber")


# Order lines carry no unique key of two columns, so their order is spelled out.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


def between_sql(text: str, start: str, end: str) -> str:
    """SQL list of the texts between two markers."""
    return f"list_transform(string_split({text}, '{start}')[2:], lambda x: string_split(x, '{end}')[1])"


def rows_sql(table: str, key: str, lists: str, columns: str) -> str:
    """SQL that numbers the elements of lists: ``lists`` defines ``v``, ``columns`` reads ``x`` and ``pos``."""
    return f"""
        WITH l AS (SELECT {key}, {lists} AS v FROM {table}),
             r AS (SELECT {key}, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM l)
        SELECT {key}, {columns} FROM r"""
