import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom.functions import dates, money, text
from salesloom.sources.inline import literal_rows, one_row, with_fallback_row


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("number", "expected"),
    [(0, "           0"), (1234567.5, "   1,234,568"), (-5, "          -5"), (10**9, " ###,###,###"), (None, None)],
)
def test_grouped_number_is_twelve_wide(spark, number, expected):
    assert value(spark, text.grouped_number(F.lit(number).cast("decimal(20,2)"))) == expected


def test_money_round_trip(spark):
    assert value(spark, money.cents(F.lit(1234.56))) == 123456
    assert value(spark, money.cents(F.lit(Decimal("0.29")))) == 29
    assert value(spark, money.from_cents(F.lit(-5))) == Decimal("-0.05")


def test_percent_text_keeps_trailing_zeros(spark):
    assert value(spark, money.percent_text(F.lit(123), F.lit(1000))) == "12.3000%"
    assert value(spark, money.percent_text(F.lit(None).cast("int"), F.lit(1000))) == "%"
    assert value(spark, money.percent(F.lit(1), F.lit(0))) is None


def test_concat_treats_null_as_empty(spark):
    assert value(spark, text.concat_skip_nulls(F.lit("x"), F.lit(None))) == "x"


def test_quarters(spark):
    assert dates.quarter_bounds(dt.date(2024, 11, 30)) == (dt.date(2024, 10, 1), dt.date(2025, 1, 1))
    assert dates.months_later(dt.date(2006, 2, 1), -3) == dt.date(2005, 11, 1)
    assert dates.months_later(dt.date(2000, 5, 31), -3) == dt.date(2000, 2, 29)
    assert value(spark, text.quarter_label(F.lit(dt.date(2025, 5, 2)))) == "2025-Q2"


def test_whole_days_drop_the_part_of_a_day(spark):
    start, end = (F.lit(s).cast("timestamp_ntz") for s in ("2020-01-01 12:00", "2020-01-11 00:00"))
    assert value(spark, dates.whole_days(end, start)) == 9


def test_required_text():
    assert text.require_text("x", "name") == "x"
    for bad in (None, "", "  "):
        with pytest.raises(ValueError):
            text.require_text(bad, "name")


def test_fallback_row_only_when_empty(spark):
    df = literal_rows(spark, "a int, b string", [(1, "x"), (2, None)])
    assert [tuple(r) for r in with_fallback_row(df, {"a": 0, "b": "none"}).collect()] == [(1, "x"), (2, None)]
    empty = df.filter("a > 5")
    assert [tuple(r) for r in with_fallback_row(empty, {"a": 0, "b": "none"}).collect()] == [(0, "none")]


def test_one_row_accepts_values_and_expressions(spark):
    row = one_row(spark, {"a": 1, "b": F.array(F.lit("x"), F.lit("y")), "c": None}).first()
    assert (row.a, row.b, row.c) == (1, ["x", "y"], None)
