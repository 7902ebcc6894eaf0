"""Top-k, ranks and latest row per key; row numbers and the nth row come from ``ordered``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.operators.ordered import nth_row, number_rows

__all__ = ["latest_per_key", "nth_row", "number_rows", "top_dense_ranks", "top_k_per_group"]


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, column: str | None = None
) -> DataFrame:
    """First ``k`` rows of each group; ``order`` must end in a unique key.

    One shuffle: every task first cuts its groups to ``k`` rows, so a group of any size reaches its last task as at
    most ``k`` rows per task. Spark does so up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000); with a
    greater ``k`` a whole group is sorted in one task, spilled to disk where it has to be.
    """
    rank = column or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col(rank) <= k)
    return kept if column else kept.drop(rank)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. State the null placement in ``order``."""
    return top_k_per_group(df, keys, order, 1)


def top_dense_ranks(
    df: DataFrame, group: Sequence[str], value: str, n: int, column: str = "rn"
) -> DataFrame:
    """Rows whose ``value`` is among the ``n`` highest distinct values of their group (ties kept).

    The distinct values are ranked first, which needs at most ``n`` rows per group; the rows then
    meet their rank in an equi-join, so no task ever holds a whole group. Spark broadcasts the ranks if they
    turn out to be small.
    """
    keys = [*group, value]
    distinct = df.select(*keys).filter(F.col(value).isNotNull()).distinct()
    ranks = top_k_per_group(distinct, group, [F.col(value).desc_nulls_last()], n, column)
    return df.join(ranks, keys)
