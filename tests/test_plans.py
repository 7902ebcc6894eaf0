"""Shape of the physical plans, also under the conditions of large tables (nothing fits a broadcast)."""

import pytest
from pyspark.sql import functions as F

from salesloom import registry
from salesloom.sources import roles
from salesloom.sources.tables import Tables

ROOT = "/root/testdata/sf0.001"
registry.load_all()
QUERIES = registry.QUERIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_join_and_no_python(spark, settings, name):
    settings(autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES[name](spark, ROOT))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in plan


@pytest.mark.parametrize("name", ["top5_per_channel", "latest_row_per_key", "cohort_all_years", "popular_part_per_nation"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, ROOT))


def test_date_window_reaches_the_scan(spark, settings):
    settings(maxMetadataStringLength="1000")
    plan = plan_of(QUERIES["weekly_running_centered"](spark, ROOT))
    assert "GreaterThanOrEqual(o_orderdate,1999-11-29T00:00)" in plan
    assert "LessThan(o_orderdate,2000-01-03T00:00)" in plan


def test_scan_reads_only_needed_columns(spark, settings):
    settings(maxMetadataStringLength="1000")
    plan = plan_of(QUERIES["top_staff_revenue"](spark, ROOT))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan


def test_shared_totals_are_computed_once(spark):
    df = QUERIES["top5_per_channel"](spark, ROOT)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_hot_order_is_split_by_the_join(spark, settings):
    """A third of all lines belongs to one order: the join splits that partition instead of one task doing it."""
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="4k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="8",
    )
    tables = Tables(spark, ROOT)
    hot = F.when(F.pmod("l_partkey", F.lit(3)) == 0, F.lit(1)).otherwise(F.col("l_orderkey"))

    class Skewed:
        orders = tables.orders
        lineitem = tables.lineitem.repartition(8).withColumn("l_orderkey", hot)

    totals = roles.sales_lines(Skewed).groupBy("cust_id").agg(F.sum("amount_cents").alias("cents"))
    total = sum(row.cents for row in totals.collect())
    assert "skew=true" in plan_of(totals)
    assert total == tables.lineitem.agg(F.sum(F.rint(F.col("l_extendedprice") * 100).cast("bigint"))).first()[0]
