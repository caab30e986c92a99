"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, mismatch
from fixture_queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


PYTHON = {"ex_01_select_elements", "ex_01_element_markup"}
SLOW = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    """Same rows as the SQL; no cross or nested-loop join, no row-at-a-time Python, and Arrow only in the element selector."""
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in SLOW if op in plan]
    assert ("ArrowEvalPython" in plan) == (name in PYTHON)
    assert mismatch(df, con, name) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_first_rows_limit_groups_before_the_shuffle(spark):
    for name in ("wn_01_first_by_id", "wn_02_first_by_id_with_blank", "jn_01_match_first", "wn_04_cut_off", "sl_02_trial_rows"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
        assert any("Partial" in line for line in limits), name


def test_hot_join_key_is_split(spark):
    from pyspark.sql import functions as F

    from catalogflow.operators.matching import match_first

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        pages = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id").cast("string"))).alias("requested_url"),
            F.sha1(F.col("id").cast("string").cast("binary")).alias("body"))
        catalog = pages.select(F.col("requested_url").alias("url")).withColumn("ord", F.monotonically_increasing_id())
        joined = match_first(pages, catalog)
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
