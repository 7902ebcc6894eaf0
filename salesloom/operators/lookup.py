"""Lookups, membership filters and counts per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.text import folded


def _members(members: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Each key once: a key that fills the member table shrinks to one row per map task before the join."""
    return members.select(*([keys] if isinstance(keys, str) else keys)).distinct()


def in_set(df: DataFrame, members: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return df.join(_members(members, keys), keys, "left_semi")


def not_in_set(df: DataFrame, members: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``members``; a NULL key occurs nowhere."""
    return df.join(_members(members, keys), keys, "left_anti")


def with_counts(df: DataFrame, details: DataFrame, key: str, column: str) -> DataFrame:
    """Number of detail rows per key, 0 where there are none."""
    counts = details.groupBy(key).agg(F.count(F.lit(1)).alias(column))
    return df.join(counts, key, "left").withColumn(column, F.coalesce(F.col(column), F.lit(0)))


def in_all_periods(df: DataFrame, key: str, period: str, periods: int) -> DataFrame:
    """Keys that occur in the given number of distinct periods."""
    counted = df.groupBy(key).agg(F.countDistinct(period).alias("_periods"))
    return counted.filter(F.col("_periods") == periods).select(key)


def lowest_dimension_key(dimension: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """One row per natural key (trimmed, without case) with the lowest surrogate key that carries it."""
    return dimension.groupBy(folded(natural).alias(natural)).agg(F.min(surrogate).alias(surrogate))


def resolve_keys(
    df: DataFrame, lookups: Mapping[str, tuple[DataFrame, str, str, str]], problem: str = "reject_reason"
) -> DataFrame:
    """Replace natural keys by surrogate keys.

    ``lookups`` maps a text column of ``df`` to ``(dimension, natural key, surrogate key, target column)``.
    Matching is exact; of several dimension rows with one natural key the lowest surrogate key wins. All rows
    are kept: ``problem`` names the first key that was not found, and is NULL for a resolved row.
    """
    reason = F.lit(None).cast("string")
    for column, (dimension, natural, surrogate, target) in reversed(lookups.items()):
        unique = (
            dimension.filter(F.col(natural).isNotNull())
            .groupBy(F.col(natural).alias(column))
            .agg(F.min(surrogate).alias(target))
        )
        df = df.join(unique, column, "left")
        reason = F.when(F.col(target).isNull(), F.lit(f"{column} not found")).otherwise(reason)
    return df.withColumn(problem, reason)


def split_rejects(df: DataFrame, problem: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(rows without a problem, rows with one)."""
    return df.filter(F.col(problem).isNull()).drop(problem), df.filter(F.col(problem).isNotNull())


def map_by_rules(
    rules: DataFrame, left: DataFrame, right: DataFrame, left_match: Mapping[str, str], right_match: Mapping[str, str]
) -> DataFrame:
    """Pairs of rows allowed by any rule: an OR of conjunctions turned into two equi-joins.

    Each rule row holds the values one term asks of the left and of the right row; the match maps name
    ``rule column -> row column`` and compare case-insensitively. A pair is returned once.
    """

    def matches(table: DataFrame, match: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
        keyed = table.withColumns({f"_{rule}": folded(column) for rule, column in match.items()})
        return keyed, [f"_{rule}" for rule in match]

    wanted = rules.select(*[folded(c).alias(f"_{c}") for c in [*left_match, *right_match]]).distinct()
    left_rows, left_keys = matches(left, left_match)
    right_rows, right_keys = matches(right, right_match)
    pairs = left_rows.join(wanted, left_keys).drop(*left_keys).join(right_rows, right_keys).drop(*right_keys)
    return pairs.select(*left.columns, *right.columns).distinct()


def label_by_value(column: Column, labels: Mapping[str, str], default: str) -> Column:
    """Simple CASE over fixed values."""
    result = None
    for value, label in labels.items():
        result = F.when(column == value, label) if result is None else result.when(column == value, label)
    return F.lit(default) if result is None else result.otherwise(default)
