"""Money and percentages.

Amounts travel through joins and aggregates as whole cents in a long: sums are exact, need no
decimal objects in the hash aggregate, and raise an error instead of wrapping when they overflow
(ANSI mode). They turn into ``decimal(38,2)`` only in the final projection.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

ONE_CENT = Decimal("0.01")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: Column | str) -> Column:
    """Whole cents of a double or decimal amount that has at most two fraction digits."""
    return F.rint(_column(amount) * 100).cast("bigint")


def from_cents(amount: Column | str) -> Column:
    return (_column(amount).cast("decimal(20,0)") * F.lit(ONE_CENT)).cast("decimal(38,2)")


def percent(part: Column | str, whole: Column | str) -> Column:
    """``100 * part / whole`` as a double; NULL when ``whole`` is zero."""
    return F.try_divide(_column(part).cast("double") * 100.0, _column(whole).cast("double"))


def percent_text(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """Share rendered with a fixed number of digits and a ``%`` sign; a missing share renders as ``%``."""
    share = F.try_divide(_column(part).cast("double"), _column(whole).cast("double")) * 100
    fixed = F.round(share, digits).cast(f"decimal({digits + 6},{digits})").cast("string")
    return F.concat(F.coalesce(fixed, F.lit("")), F.lit("%"))


def rounded_cents(mean: Column) -> Column:
    """A fractional number of cents rounded half up to whole cents."""
    return F.round(mean).cast("bigint")
