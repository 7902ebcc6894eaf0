"""Text helpers whose NULL and width rules differ from Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_skip_nulls(*parts: Column) -> Column:
    """Concatenation in which a NULL part counts as empty text."""
    return F.concat(*[F.coalesce(part.cast("string"), F.lit("")) for part in parts])


def same_text(left: Column, right: str) -> Column:
    """Case-insensitive equality with a constant."""
    return F.lower(left) == right.lower()


def folded(column: Column | str) -> Column:
    """Natural-key form of a text column: trimmed and lower-cased."""
    column = F.col(column) if isinstance(column, str) else column
    return F.lower(F.trim(column))


# A nine-digit number with separators and a sign place is twelve wide.
NUMBER_WIDTH = 12
NUMBER_LIMIT = 999_999_999
NUMBER_OVERFLOW = " ###,###,###"


def grouped_number(value: Column) -> Column:
    """Right-aligned whole number with thousands separators, ``#`` marks when it does not fit."""
    whole = F.round(value).cast("bigint")
    text = F.lpad(F.format_number(whole, 0), NUMBER_WIDTH, " ")
    return F.when(F.abs(whole) > NUMBER_LIMIT, NUMBER_OVERFLOW).otherwise(text)


def quarter_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-'Q'Q")


def require_text(value: str | None, what: str) -> str:
    """Argument check for report functions: the text must not be missing or blank."""
    if value is None or not value.strip():
        raise ValueError(f"{what} must not be empty")
    return value
