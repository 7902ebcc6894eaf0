"""Stored columns that are computed from other columns of the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: str = "first_name", last: str = "last_name") -> Column:
    """NULL when a part is NULL."""
    return F.concat(F.col(first), F.lit(" "), F.col(last))


def employee_code(name: str = "emp_name") -> Column:
    return F.upper(name)


def line_total(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    return (F.col(quantity) * F.col(unit_price)).cast("decimal(12,2)")
