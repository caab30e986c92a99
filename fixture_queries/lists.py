"""Lists per key, in long form and in bounded pieces."""

from pyspark.sql import functions as F

from catalogflow.operators import ordering
from fixture_queries.base import LINE_ORDER, LINE_ORDER_SQL, query

_LIST_SQL = f"""
    SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_ORDER_SQL}) - 1 AS pos, l_suppkey
    FROM lineitem"""


def supplier_lists(t):
    """Suppliers of each part in the order of its lines, repeats kept."""
    return ordering.numbered(
        t.lineitem.select("l_partkey", *LINE_ORDER), ["l_partkey"], LINE_ORDER
    ).select("l_partkey", "pos", "l_suppkey")


@query("ag_01_ordered_lists", _LIST_SQL)
def _(t):
    return supplier_lists(t)


@query("ag_01_list_pieces", f"""
    SELECT l_partkey, pos // 8 AS piece, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY pos) AS suppliers
    FROM ({_LIST_SQL}) GROUP BY ALL""")
def _(t):
    pieces = ordering.list_pieces(supplier_lists(t), "l_partkey", "l_suppkey", size=8)
    return pieces.select("l_partkey", "piece", F.array_join(F.col("values").cast("array<string>"), ",").alias("suppliers"))


@query("ag_02_sorted_union", """
    SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS root_id, CAST(l_partkey AS VARCHAR) || '_' || CAST(k AS VARCHAR) AS id
    FROM (SELECT l_partkey, l_suppkey AS k FROM lineitem UNION ALL SELECT l_partkey, CAST(l_quantity AS BIGINT) FROM lineitem)
    ORDER BY ALL""")
def _(t):
    root = F.col("l_partkey").cast("string")
    by = lambda c: t.lineitem.select(
        root.alias("root_id"), F.concat_ws("_", root, F.col(c).cast("bigint").cast("string")).alias("id"))
    return ordering.sorted_ids(by("l_suppkey").unionByName(by("l_quantity")), "root_id", "id")
