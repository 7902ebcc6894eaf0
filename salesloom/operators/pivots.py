"""Rows to columns for a fixed list of column values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crosstab(
    df: DataFrame, rows: Sequence[str], spread: str, values: Sequence, value: str, names: Sequence[str], total: str
) -> DataFrame:
    """One row per ``rows`` key, one summed column per listed value (missing cell 0) and a row total."""
    spread_df = df.groupBy(*rows).pivot(spread, list(values)).agg(F.sum(value))
    cells = [F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(n) for v, n in zip(values, names)]
    filled = spread_df.select(*rows, *cells)
    row_total = F.lit(0)
    for name in names:
        row_total = row_total + F.col(name)
    return filled.withColumn(total, row_total)


def sums_by_value(test: Column, value: Column, columns: Mapping[str, str]) -> list[Column]:
    """Conditional sums: one aggregate per (column name, wanted value)."""
    return [F.sum(F.when(test == wanted, value).otherwise(0)).alias(name) for name, wanted in columns.items()]
