"""Ordered work in slices equals the one-task form, also with a key that holds half of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.operators import ordered
from salesloom.operators.ordered import By


@pytest.fixture(scope="module")
def rows():
    """id, key (half of the rows have key 1), time with ties and NULLs, value with NULLs."""
    rng = random.Random(9)
    keys = [1 if i % 2 else rng.choice([None, 0, 2, 3, 4, 5]) for i in range(900)]
    return [(i, k, rng.choice([None, *range(300)]), rng.choice([None, *range(-5, 50)])) for i, k in enumerate(keys)]


@pytest.fixture
def table(spark, rows):
    return spark.createDataFrame(rows, "id int, k int, t int, v bigint").repartition(3)


def nulls_first(value):
    return (value is not None, value or 0)


def test_slices_follow_the_order_and_share_the_rows(table, rows):
    order = [By("t", descending=True), By("id", nulls_first=False)]
    found = ordered.sliced(table, order, slices=6).collect()
    ranked = sorted(found, key=lambda r: (r.t is None, -(r.t or 0), r.id))
    assert [r._slice for r in ranked] == sorted(r._slice for r in found)
    sizes = [sum(r._slice == s for r in found) for s in range(6)]
    assert sum(sizes) == len(rows) and min(sizes) > 60 and max(sizes) < 300


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("first", [None, False, True])
def test_order_of_nulls(spark, descending, first):
    df = spark.createDataFrame([(v, i) for i, v in enumerate([None, 3.0, float("nan"), -1.0, None, 0.0] * 20)], "v double, id int")
    by = By("v", descending, first)
    found = ordered.number_rows(df, [by, "id"], "n").orderBy("n").select("id").collect()
    assert [r.id for r in found] == [r.id for r in df.orderBy(by.sort(), "id").collect()]
    assert By.of(by.sort()) == By("v", descending, by._first)


def test_running_totals_and_frames(table, rows):
    ranked = sorted(rows, key=lambda r: (nulls_first(r[2]), r[0]))
    running = {r.id: r.s for r in ordered.running_totals(table, ["t", "id"], {"s": "v"}).collect()}
    total = None
    for i, _, _, v in ranked:
        total = total if v is None else v + (total or 0)
        assert running[i] == total
    for before, after, block in ((2, 1, 7), (0, 3, 3), (1, 1, 100_000)):
        framed = ordered.rows_frame(table, ["t", "id"], {"s": F.sum("v"), "m": F.max("t")}, before, after, block)
        assert framed.columns == ["id", "k", "t", "v", "s", "m"]
        found = {r.id: (r.s, r.m) for r in framed.collect()}
        assert len(found) == len(rows)
        for n, row in enumerate(ranked):
            near = ranked[max(0, n - before) : n + after + 1]
            values, times = [r[3] for r in near if r[3] is not None], [r[2] for r in near if r[2] is not None]
            assert found[row[0]] == (sum(values) if values else None, max(times, default=None))


def test_ranges_groups_and_dense_ranks(table, rows):
    by_range = {r.id: r.s for r in ordered.range_total(table, "t", F.lit(7), "v", "s").collect()}
    by_group = {r.id: r.s for r in ordered.groups_total(table, "t", 2, "v", "s", block_rows=5).collect()}
    ranks = {r.id: r.n for r in ordered.dense_ranked(table, By("t", descending=True), "n").collect()}
    times = sorted({r[2] for r in rows}, key=nulls_first)
    down = sorted({r[2] for r in rows}, key=lambda t: (t is None, -(t or 0)))

    def total(keep):
        values = [r[3] for r in rows if keep(r[2]) and r[3] is not None]
        return sum(values) if values else None

    for t in times:
        place = times.index(t)
        groups = total(lambda x: x in times[max(0, place - 2) : place + 1])
        reach = total(lambda x: x is t if t is None or x is None else t - 7 <= x <= t)
        for i in (r[0] for r in rows if r[2] == t):
            assert (by_range[i], by_group[i], ranks[i]) == (reach, groups, down.index(t) + 1)


@pytest.mark.parametrize("slices", [1, 9])
@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("same_time", [False, True])
def test_asof_join(spark, table, rows, slices, forward, same_time):
    offered = [(k, t, i, v) for i, k, t, v in rows if i % 3 == 0]
    right = spark.createDataFrame(offered, "k int, at int, rid int, payload bigint")
    found = ordered.asof_join(table, right, ["k"], "t", "at", ["payload", "rid"], ["rid"], forward, same_time, slices)
    assert found.columns == ["id", "k", "t", "v", "payload", "rid"]
    result = {r.id: (r.k, r.t, r.v, r.payload, r.rid) for r in found.collect()}
    assert len(result) == len(rows)
    for i, k, t, v in rows:
        best = (None, None)
        if k is not None and t is not None:
            sign = -1 if forward else 1
            known = [r for r in offered if r[0] == k and r[1] is not None]
            near = [r for r in known if sign * r[1] < sign * t or (same_time and r[1] == t)]
            if near:
                last = max(near, key=lambda r: (sign * r[1], sign * r[2]))
                best = last[3], last[2]
        assert result[i] == (k, t, v, *best)


def test_asof_join_over_a_hot_key_uses_many_tasks_and_makes_no_pairs(spark, settings):
    settings(shuffle__partitions="8", autoBroadcastJoinThreshold="-1", adaptive__coalescePartitions__enabled="false")
    left = spark.range(6000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
    right = spark.range(0, 6000, 1000).select(F.lit(1).alias("k"), F.col("id").alias("at"), F.col("id").alias("x"))
    found = ordered.asof_join(left, right, ["k"], "t", "at", ["x"])
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert all(r.x == r.t // 1000 * 1000 for r in rows)
    sizes = [sum(r.task == task for r in rows) for task in {r.task for r in rows}]
    assert len(sizes) > 3 and max(sizes) < 4000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_column_names_must_differ(table):
    with pytest.raises(ValueError, match="left side"):
        ordered.asof_join(table, table, ["k"], "t", "t", ["v"])


def test_nth_row_everywhere(table, rows):
    ranked = sorted(rows, key=lambda r: (nulls_first(r[2]), r[0]))
    for n in (0, 1, 449, 898, 899):
        assert rows_of(ordered.nth_row(table, ["t", "id"], n)) == [ranked[n]]
    assert ordered.nth_row(table, ["t", "id"], 900).collect() == []
    middle = table.agg(F.floor(F.count(F.lit(1)) / 2)).scalar()
    assert rows_of(ordered.nth_row(table, ["t", "id"], middle)) == [ranked[450]]


def test_numbers_within_groups(table, rows):
    found = {r.id: r.n for r in ordered.numbers_within(table, ["k"], [By("id", descending=True)], "n").collect()}
    for i, k, _, _ in rows:
        assert found[i] == sum(r[1] == k and r[0] >= i for r in rows)


@pytest.mark.parametrize("crowd", [0, 100, 1_000_000])
def test_numbers_of_groups_in_slices_or_not(monkeypatch, table, rows, crowd):
    """All groups in slices, the group of half of the rows, or none; the first column may be NULL and repeat."""
    monkeypatch.setattr(ordered, "CROWD_ROWS", crowd)
    found = {r.id: r.n for r in ordered.numbers_within(table, ["k"], [By("t"), By("id", descending=True)], "n").collect()}
    numbers = {r.id: r.n for r in ordered.number_rows_by(table, "k", ["t", "id"], "n").collect()}
    by_key = sorted(rows, key=lambda r: (nulls_first(r[1]), nulls_first(r[2]), -r[0]))
    places = {}
    for i, k, _, _ in by_key:
        places[k] = places.get(k, 0) + 1
        assert found[i] == places[k]
    ranked = sorted(rows, key=lambda r: (nulls_first(r[1]), nulls_first(r[2]), r[0]))
    assert [numbers[r[0]] for r in ranked] == list(range(1, len(rows) + 1))


def test_small_groups_are_not_cut_into_slices(table):
    """One shuffle by the group; numbering all rows in slices first took most of the time of ``rent_one_each``."""
    numbered = ordered.numbers_within(table, ["k"], ["id"], "n")
    numbered.collect()
    final = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" in final and "_slice" not in final


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id int, k int, t int, v bigint")
    other = spark.createDataFrame([(1, 1, 2)], "k int, at int, x int")
    assert ordered.number_rows(empty, ["id"]).collect() == []
    assert ordered.range_total(empty, "t", F.lit(1), "v", "s").collect() == []
    assert ordered.groups_total(empty, "t", 2, "v", "s").collect() == []
    assert ordered.asof_join(empty, other, ["k"], "t", "at", ["x"]).collect() == []
    left = spark.createDataFrame([(1, 1, 3, 4)], "id int, k int, t int, v bigint")
    assert rows_of(ordered.asof_join(left, other.limit(0), ["k"], "t", "at", ["x"])) == [(1, 1, 3, 4, None)]


def test_planning_starts_no_job(spark, table):
    """Slices are found inside the plan: nothing is run or written before the result is asked for."""
    spark.sparkContext.setJobGroup("planning", "planning")
    numbered = ordered.number_rows(table, ["t", "id"])
    ordered.running_totals(numbered, ["row_num"], {"s": "v"})
    ordered.nth_row(table, ["id"], 3)
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_only_a_row_per_slice_meets_in_one_task(spark, table):
    plan = ordered.running_totals(table, ["t", "id"], {"s": "v"})._jdf.queryExecution().executedPlan().toString()
    main = "\n".join(line for line in plan.split("\n") if "Subquery" not in line)
    for part in main.split("Exchange SinglePartition")[1:]:
        assert "HashAggregate(keys=[_slice" in part.split("\n", 2)[1]


def test_dates_and_intervals(spark):
    day = dt.datetime(2024, 1, 1)
    moments = [(i, day + dt.timedelta(minutes=m), 1) for i, m in enumerate((0, 30, 60, 61, 200))]
    df = spark.createDataFrame(moments, "id int, ts timestamp_ntz, v bigint")
    found = ordered.range_total(df, "ts", F.make_dt_interval(hours=F.lit(1)), "v", "s")
    assert {r.id: r.s for r in found.collect()} == {0: 1, 1: 2, 2: 3, 3: 3, 4: 1}
