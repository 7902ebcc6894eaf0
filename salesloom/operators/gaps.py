"""Distances between neighbouring values of a key.

"No row in between" never needs pairs of rows: two values are neighbours exactly when one follows
the other in the sorted distinct values, so a ``lead`` or a sorted set replaces the inequality
self-join and its anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.operators.frames import next_value


def adjacent_values(df: DataFrame, key: str, value: str, following: str = "next_value") -> DataFrame:
    """Each distinct value of a key with the next higher one; the last value of a key has none."""
    distinct = df.select(key, value).filter(F.col(value).isNotNull()).distinct()
    return distinct.withColumn(following, next_value(value, [key])).filter(F.col(following).isNotNull())


def longest_gap(df: DataFrame, key: str, value: str, column: str = "max_gap") -> DataFrame:
    pairs = adjacent_values(df, key, value, "_next")
    return pairs.groupBy(key).agg(F.max(F.col("_next") - F.col(value)).alias(column))


def longest_gap_by_set(df: DataFrame, key: str, value: str, column: str = "max_gap") -> DataFrame:
    """Same result from the sorted set of values per key.

    For domains whose size is fixed, such as calendar years: the set never outgrows the domain.
    """
    years = df.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("_values"))
    return (
        years.filter(F.size("_values") > 1)
        .withColumn("_later", F.slice("_values", F.lit(2), F.size("_values") - 1))
        .withColumn("_earlier", F.slice("_values", F.lit(1), F.size("_values") - 1))
        .select(key, F.array_max(F.zip_with("_later", "_earlier", lambda b, a: b - a)).alias(column))
    )
