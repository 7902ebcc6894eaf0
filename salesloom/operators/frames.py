"""Window frames by rows, calendar days and peer groups.

Feed these with totals (per day, per category, per key and day), never with raw facts: a frame
without partition columns runs in one task, and totals keep its input as small as the calendar or
the category list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(value: str, order: str, within: Sequence[str]) -> Column:
    window = Window.partitionBy(*within).orderBy(order)
    return F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def centred_average(value: str, order: str, reach: int = 1, within: Sequence[str] = ()) -> Column:
    window = Window.partitionBy(*within).orderBy(order)
    return F.avg(value).over(window.rowsBetween(-reach, reach))


def trailing_rows_sum(value: str, order: str, rows: int, within: Sequence[str] = ()) -> Column:
    window = Window.partitionBy(*within).orderBy(order)
    return F.sum(value).over(window.rowsBetween(-rows, Window.currentRow))


def trailing_days_sum(value: str, day: str, days: int, within: Sequence[str] = ()) -> Column:
    """Sum over the current date and the ``days`` calendar days before it."""
    window = Window.partitionBy(*within).orderBy(F.unix_date(F.col(day)))
    return F.sum(value).over(window.rangeBetween(-days, Window.currentRow))


def trailing_groups_sum(
    df: DataFrame, value: str, order: str, groups: int, column: str, within: Sequence[str] = ()
) -> DataFrame:
    """Sum over the current peer group and the ``groups`` peer groups before it.

    Spark has no ``GROUPS`` frame: peers get a dense rank, and a range over that rank is the frame.
    """
    window = Window.partitionBy(*within)
    ranked = df.withColumn("_peer", F.dense_rank().over(window.orderBy(order)))
    frame = window.orderBy("_peer").rangeBetween(-groups, Window.currentRow)
    return ranked.withColumn(column, F.sum(value).over(frame)).drop("_peer")


def previous_value(value: str, order: str, within: Sequence[str]) -> Column:
    return F.lag(value).over(Window.partitionBy(*within).orderBy(order))


def next_value(value: str, within: Sequence[str]) -> Column:
    """The next higher value of the same column within a key; values must be distinct per key."""
    return F.lead(value).over(Window.partitionBy(*within).orderBy(value))


def group_total(value: str, within: Sequence[str]) -> Column:
    """Total of a group on each of its rows. For totals only: the group meets in one task."""
    return F.sum(value).over(Window.partitionBy(*within))
