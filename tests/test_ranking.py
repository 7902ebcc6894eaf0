import random

from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.operators.ranking import latest_per_key, nth_row, number_rows, top_dense_ranks, top_k_per_group


def test_top_k_keeps_k_rows_and_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", 5, 1), ("a", 5, 2), ("a", 4, 3), ("b", 1, 4)], "g string, v int, id int")
    top = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 2)
    assert rows_of(top) == [("a", 5, 1), ("a", 5, 2), ("b", 1, 4)]


def test_top_k_beyond_the_limit_threshold_gives_the_same_rows(spark, settings):
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), F.col("id").alias("v"), F.lit("x").alias("t"))
    order = [F.col("v").desc()]
    expected = rows_of(top_k_per_group(df, ["g"], order, 40, "rn"))
    settings(optimizer__windowGroupLimitThreshold="10")
    assert rows_of(top_k_per_group(df, ["g"], order, 40, "rn")) == expected
    assert len(expected) == 80


def test_dense_ranks_keep_ties_and_skip_nulls(spark):
    rows = [("a", 9), ("a", 9), ("a", 7), ("a", 5), ("a", None), ("b", 1)]
    df = spark.createDataFrame(rows, "g string, v int")
    ranked = top_dense_ranks(df, ["g"], "v", 2).select("g", "v", "rn")
    assert rows_of(ranked) == [("a", 7, 2), ("a", 9, 1), ("a", 9, 1), ("b", 1, 1)]


def test_latest_row_null_placement(spark):
    df = spark.createDataFrame([(1, None, 10), (1, 5, 11), (1, 7, 12), (2, None, 13)], "k int, d int, id int")
    last = latest_per_key(df, ["k"], [F.col("d").desc_nulls_last(), F.col("id")])
    first = latest_per_key(df, ["k"], [F.col("d").desc_nulls_first(), F.col("id")])
    assert rows_of(last) == [(1, 7, 12), (2, None, 13)]
    assert rows_of(first) == [(1, None, 10), (2, None, 13)]


def test_numbers_are_consecutive_over_skewed_values(spark):
    rng = random.Random(3)
    values = [7] * 400 + [rng.randrange(1000) for _ in range(800)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(5)
    numbered = number_rows(df, [F.col("v").desc(), F.col("id")], "n")
    expected = {row[0]: n for n, row in enumerate(sorted(enumerate(values), key=lambda r: (-r[1], r[0])), 1)}
    assert {r["id"]: r["n"] for r in numbered.collect()} == expected


def test_numbering_an_empty_relation(spark):
    assert number_rows(spark.createDataFrame([], "id int"), [F.col("id")]).collect() == []


def test_numbers_stay_the_same_when_read_again(spark):
    numbered = number_rows(spark.range(100).select(F.rand().alias("r"), "id"), [F.col("r")], "n")
    assert rows_of(numbered.select("id", "n")) == rows_of(numbered.select("id", "n"))


def test_nth_row_counts_from_zero(spark):
    df = spark.range(10)
    assert rows_of(nth_row(df, [F.col("id")], 3)) == [(3,)]
    assert rows_of(nth_row(df, [F.col("id")], 10)) == []
