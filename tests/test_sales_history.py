"""Sales reports on a small star: missing day, peers, year before the report, ties."""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import rows_of
from salesloom.plans import sales_history as sales

D = dt.date


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [(1, "Ann", "Asia"), (2, "Bob", "Asia"), (3, "Cy", "Europe")], "cust_id int, cust_name string, country_region string"
    )


def regional(fact, customers):
    return fact.join(customers.drop("cust_name"), "cust_id")


def names(customers):
    return customers.select("cust_id", "cust_name")


def facts(spark, *rows):
    return spark.createDataFrame(
        list(rows), "prod_id int, cust_id int, time_id date, channel_desc string, amount_cents bigint"
    )


def test_tied_customers_take_both_places_in_key_order(spark, customers):
    fact = facts(spark, (1, 2, D(2000, 1, 1), "web", 500), (1, 1, D(2000, 1, 1), "web", 500), (1, 3, D(2000, 1, 1), "web", 1))
    top = sales.top_customers_per_channel(fact, names(customers), k=2).collect()
    assert [(r.cust_id, r.total_sales, r.sales_percentage) for r in top] == [
        (1, Decimal("5.00"), "49.9500%"),
        (2, Decimal("5.00"), "49.9500%"),
    ]


def test_cohort_needs_every_year(spark, customers):
    fact = facts(
        spark,
        (1, 1, D(1998, 1, 1), "web", 10),
        (1, 1, D(1999, 1, 1), "shop", 10),
        (1, 2, D(1998, 1, 1), "web", 10),
        (1, 3, D(1998, 1, 1), "web", 5),
        (1, 3, D(1999, 1, 1), "web", 20),
        (1, 1, D(2000, 1, 1), "web", 1000),
    )
    one = sales.consistent_top_customers(fact, names(customers), (1998, 1999), rank=1)
    assert rows_of(one) == []
    two = sales.consistent_top_customers(fact, names(customers), (1998, 1999), rank=2)
    assert rows_of(two.select("channel_desc", "cust_id", "amount_sold")) == [
        ("shop", 1, Decimal("0.10")),
        ("web", 1, Decimal("0.10")),
        ("web", 3, Decimal("0.25")),
    ]


def test_first_reported_year_has_a_predecessor(spark, customers):
    fact = facts(
        spark,
        (1, 1, D(1998, 5, 1), "web", 1035),
        (1, 1, D(1998, 5, 1), "shop", 8965),
        (1, 2, D(1999, 5, 1), "web", 1190),
        (1, 2, D(1999, 5, 1), "shop", 8810),
        (1, 3, D(1999, 5, 1), "fax", 1),
        (1, 1, D(1997, 5, 1), "web", 7),
    )
    out = sales.channel_share_by_year(regional(fact, customers), ["ASIA", "europe"], 1999, 1999)
    assert [tuple(r)[2:] for r in out.collect()] == [
        ("shop", Decimal("88.10"), Decimal("88.10"), Decimal("89.65"), Decimal("-1.55")),
        ("web", Decimal("11.90"), Decimal("11.90"), Decimal("10.35"), Decimal("1.55")),
        ("fax", Decimal("0.01"), Decimal("100.00"), None, None),
    ]


def test_edge_weeks_feed_the_average(spark):
    days = [D(1999, 12, 5) + dt.timedelta(days=i) for i in range(4)]
    fact = facts(spark, *[(1, 1, day, "web", 100 * (i + 1)) for i, day in enumerate(days)])
    with_edges = sales.weekly_running_sales(fact, 1999, 49, 49).collect()
    assert [(r.time_id, r.cum_sum, r.centered_3_day_avg) for r in with_edges] == [
        (days[1], Decimal("2.00"), Decimal("2.00")),
        (days[2], Decimal("5.00"), Decimal("3.00")),
        (days[3], Decimal("9.00"), Decimal("3.50")),
    ]
    written = sales.weekly_running_sales(fact, 1999, 49, 49, edge_weeks=False).collect()
    assert [r.centered_3_day_avg for r in written] == [Decimal("2.50"), Decimal("3.00"), Decimal("3.50")]


def test_moving_sums_on_missing_days(spark):
    fact = facts(spark, *[(p, 1, D(2000, 1, d), "web", d) for p in (1, 2) for d in (1, 2, 8, 9)])
    by_product = sales.product_three_day_sales(fact).filter("prod_id = 1").collect()
    assert [int(r.sum_last_3_days * 100) for r in by_product] == [1, 3, 11, 19]
    by_day = sales.seven_day_sales(fact).collect()
    assert [int(r.sales_last_7_calendar_days * 100) for r in by_day] == [2, 6, 20, 34]
    assert by_day[0].day_name == "Saturday"


def test_promotion_peers(spark):
    fact = spark.createDataFrame([(1, 1), (2, 2), (3, 4), (4, 8)], "promo_id int, amount_cents bigint")
    promotions = spark.createDataFrame(
        [(1, 1, "a"), (2, 1, "b"), (3, 5, "c"), (4, 9, "d")], "promo_id int, promo_category_id int, promo_category string"
    )
    out = sales.promotion_group_sales(fact, promotions).collect()
    assert [int(r.sales_last_3_promo_groups * 100) for r in out] == [3, 3, 7, 15]


def test_pivots(spark, customers):
    products = spark.createDataFrame(
        [(1, "cam", "Photo"), (2, "tv", "Video")], "prod_id int, prod_name string, prod_category string"
    )
    fact = facts(
        spark,
        (1, 1, D(2000, 1, 5), "web", 150),
        (1, 2, D(2000, 12, 5), "web", 250),
        (1, 3, D(2000, 2, 5), "web", 100_000_049),
        (2, 1, D(2000, 1, 5), "web", 1),
        (1, 1, D(1999, 1, 5), "web", 1),
    )
    fact = regional(fact, customers)
    table = sales.quarter_crosstab(fact, products, "photo", 2000, "asia").collect()
    assert [tuple(r) for r in table] == [
        (1, "cam", Decimal("1.50"), Decimal("0.00"), Decimal("0.00"), Decimal("2.50"), Decimal("4.00"))
    ]
    pivot = sales.month_region_pivot(fact, products, 2000, (1, 2, 3), {"Asia SALES": "Asia", "Europe SALES": "Europe"})
    assert [tuple(r) for r in pivot.collect()] == [
        ("2000-01", "Photo", "           2", "           0"),
        ("2000-01", "Video", "           0", "           0"),
        ("2000-02", "Photo", "           0", "   1,000,000"),
    ]


def test_fact_from_a_normalised_star(spark):
    sold = spark.createDataFrame(
        [(1, 1, D(2000, 1, 1), 9, Decimal("0.29")), (1, 2, D(2000, 1, 1), 9, Decimal("10.00"))],
        "prod_id int, cust_id int, time_id date, channel_id int, amount_sold decimal(12,2)",
    )
    channels = spark.createDataFrame([(9, "web")], "channel_id int, channel_desc string")
    people = spark.createDataFrame([(1, "Ann", "Li", 5), (2, "Bo", "Re", 5)], "cust_id int, first string, last string, country_id int")
    countries = spark.createDataFrame([(5, "Asia")], "country_id int, country_region string")
    fact = sales.star_fact(sold, channels, people, countries)
    top = sales.top_customers_per_channel(fact, people.select("cust_id", "last", "first"), 1)
    assert [tuple(r) for r in top.collect()] == [("web", 2, "Re", "Bo", Decimal("10.00"), "97.1817%")]
    share = sales.channel_share_by_year(fact, ["asia"], 2000, 2000).first()
    assert share["% BY CHANNELS"] == 100


def test_week_52_ends_with_its_iso_year(spark):
    """The first of January 2012 is the last day of week 52 of 2011, not the first of week 52 of 2012."""
    days = [D(2011, 12, 31), D(2012, 1, 1), D(2012, 1, 2), D(2012, 12, 24)]
    fact = facts(spark, *[(1, 1, day, "web", 100) for day in days])
    last = sales.weekly_running_sales(fact, 2012, 52, 52).collect()
    assert [(r.time_id, r.cum_sum) for r in last] == [(D(2012, 12, 24), Decimal("1.00"))]
    first = sales.weekly_running_sales(fact, 2012, 1, 1).collect()
    assert [(r.time_id, r.centered_3_day_avg) for r in first] == [(D(2012, 1, 2), Decimal("1.00"))]


def test_days_without_sales_carry_the_balance(spark):
    fact = facts(spark, (1, 1, D(2000, 2, 27), "web", 100), (1, 1, D(2000, 3, 1), "web", 50), (1, 1, D(2000, 3, 1), "web", 25))
    found = [tuple(r)[:1] + tuple(r)[2:] for r in sales.daily_balance(fact).collect()]
    one, cents = D(2000, 2, 27), Decimal("1.00")
    assert found == [
        (one, cents, one, cents, cents),
        (D(2000, 2, 28), 0, one, cents, cents),
        (D(2000, 2, 29), 0, one, cents, cents),
        (D(2000, 3, 1), Decimal("0.75"), D(2000, 3, 1), Decimal("0.75"), Decimal("1.75")),
    ]
    assert sales.daily_balance(fact.limit(0)).collect() == []


def test_weeks_of_two_years_are_told_apart(spark):
    days = [D(2012, 12, 24), D(2012, 12, 25), D(2012, 12, 26), D(2011, 12, 31), D(2012, 1, 1)]
    fact = facts(spark, *[(1, 1, day, "web", 100) for day in days])
    full = sales.weekly_running_sales(fact, 2012, 1, 52).collect()
    assert [(r.time_id, r.cum_sum) for r in full] == [(days[i], Decimal(f"{i + 1}.00")) for i in range(3)]
