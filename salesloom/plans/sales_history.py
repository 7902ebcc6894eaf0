"""Reports over a sales star.

``sales``: prod_id, cust_id, time_id (date), channel_desc, country_region, amount_cents; a report uses only the
columns it needs, and ``star_fact`` builds it from normalised tables. ``customers``: cust_id and the name columns
to show. ``products``: prod_id, prod_name, prod_category.

Reports total the fact before they meet a dimension, so a heavy product, customer or channel is combined
inside the map tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.functions.dates import dense_calendar, with_calendar
from salesloom.functions.money import cents, from_cents, percent, percent_text, rounded_cents
from salesloom.functions.text import grouped_number
from salesloom.operators import frames
from salesloom.operators.pivots import crosstab, sums_by_value
from salesloom.operators.ranking import top_dense_ranks, top_k_per_group


def _total(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum("amount_cents").alias("amount_cents"))


def star_fact(sales: DataFrame, channels: DataFrame, customers: DataFrame, countries: DataFrame) -> DataFrame:
    """The fact from a normalised star: amounts in cents, with channel and region.

    ``sales`` has cust_id, channel_id and amount_sold, ``customers`` country_id, ``countries`` country_region.
    """
    places = customers.join(countries, "country_id").select("cust_id", "country_region")
    return (
        sales.join(channels.select("channel_id", "channel_desc"), "channel_id")
        .join(places, "cust_id")
        .withColumn("amount_cents", cents("amount_sold"))
        .drop("channel_id", "amount_sold")
    )


def _name_columns(customers: DataFrame) -> list[str]:
    return [c for c in customers.columns if c != "cust_id"]


def top_customers_per_channel(sales: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    """Best ``k`` customers of each channel with their share of the channel."""
    per_customer = _total(sales, "channel_desc", "cust_id")
    best = top_k_per_group(per_customer, ["channel_desc"], [F.col("amount_cents").desc(), F.col("cust_id")], k)
    channels = per_customer.groupBy("channel_desc").agg(F.sum("amount_cents").alias("channel_cents"))
    return (
        best.join(channels, "channel_desc")
        .join(customers, "cust_id")
        .orderBy("channel_desc", F.col("amount_cents").desc(), "cust_id")
        .select(
            "channel_desc",
            "cust_id",
            *_name_columns(customers),
            from_cents("amount_cents").alias("total_sales"),
            percent_text("amount_cents", "channel_cents").alias("sales_percentage"),
        )
    )


def consistent_top_customers(
    sales: DataFrame, customers: DataFrame, years: Sequence[int], rank: int = 300
) -> DataFrame:
    """Sales by channel of the customers ranked within ``rank`` in every one of ``years`` (ties share a rank)."""
    dated = sales.withColumn("calendar_year", F.year("time_id")).filter(F.col("calendar_year").isin(*years))
    totals = _total(dated, "cust_id", "calendar_year", "channel_desc").withColumn(
        "year_cents", frames.group_total("amount_cents", ["cust_id", "calendar_year"])
    )
    ranked = top_dense_ranks(totals, ["calendar_year"], "year_cents", rank)
    periods = sorted(set(years))
    year = F.element_at(F.create_map(*[F.lit(x) for i, y in enumerate(periods) for x in (y, 1 << i)]), F.col("calendar_year"))
    # One bit per year: combined in the map tasks, then over the few channels of a customer.
    by_channel = ranked.groupBy("channel_desc", "cust_id").agg(
        F.sum("amount_cents").alias("amount_cents"), F.bit_or(year).alias("_years")
    )
    held = F.bit_or("_years").over(Window.partitionBy("cust_id"))
    cohort = by_channel.withColumn("_held", held).filter(F.col("_held") == (1 << len(periods)) - 1)
    return (
        cohort.join(customers, "cust_id")
        .orderBy(F.col("amount_cents").desc(), "cust_id", "channel_desc")
        .select("channel_desc", "cust_id", *_name_columns(customers), from_cents("amount_cents").alias("amount_sold"))
    )


def channel_share_by_year(sales: DataFrame, regions: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Channel share of each region and year next to the year before.

    The year before ``first_year`` is read as well, so the first reported year has a predecessor.
    """
    dated = sales.withColumn("calendar_year", F.year("time_id")).filter(
        F.col("calendar_year").between(first_year - 1, last_year)
    )
    wanted = dated.filter(F.lower("country_region").isin(*[r.lower() for r in regions]))
    base = _total(wanted, "country_region", "calendar_year", "channel_desc")
    share = percent("amount_cents", frames.group_total("amount_cents", ["country_region", "calendar_year"]))
    with_share = base.withColumn("share", share)
    with_previous = with_share.withColumn(
        "previous", frames.previous_value("share", "calendar_year", ["country_region", "channel_desc"])
    )
    now, before = (F.round(c, 2).cast("decimal(10,2)") for c in ("share", "previous"))
    return (
        with_previous.filter(F.col("calendar_year").between(first_year, last_year))
        .select(
            "country_region",
            "calendar_year",
            "channel_desc",
            from_cents("amount_cents").alias("amount_sold"),
            now.alias("% BY CHANNELS"),
            before.alias("% PREVIOUS PERIOD"),
            (now - before).cast("decimal(10,2)").alias("% DIFF"),
        )
        .orderBy("country_region", "calendar_year", "channel_desc")
    )


def weekly_running_sales(
    sales: DataFrame, year: int, first_week: int, last_week: int, edge_weeks: bool = True
) -> DataFrame:
    """Daily sales with the running sum of the week and a three-day centred average.

    With ``edge_weeks`` the weeks around the report feed the average of its first and last day; without, the
    average sees reported days only.
    """
    monday, sunday = dt.date.fromisocalendar(year, first_week, 1), dt.date.fromisocalendar(year, last_week, 7)
    week = dt.timedelta(days=7)
    first, last = (monday - week, sunday + week) if edge_weeks else (monday, sunday)
    days = with_calendar(_total(sales, "time_id"), "time_id", "calendar_week_number", "day_name")
    days = days.withColumn("_monday", F.date_trunc("week", "time_id"))  # week numbers repeat at the edges of a year
    read = days.filter(F.col("time_id").between(F.lit(first), F.lit(last)))
    framed = read.withColumns(
        {
            "running": frames.running_sum("amount_cents", "time_id", ["_monday"]),
            "centred": frames.centred_average("amount_cents", "time_id"),
        }
    )
    return (
        framed.filter(F.col("time_id").between(F.lit(monday), F.lit(sunday)))
        .select(
            "calendar_week_number",
            "time_id",
            "day_name",
            from_cents("amount_cents").alias("sales"),
            from_cents("running").alias("cum_sum"),
            from_cents(rounded_cents(F.col("centred"))).alias("centered_3_day_avg"),
        )
        .orderBy("time_id")
    )


def product_three_day_sales(sales: DataFrame) -> DataFrame:
    """Daily sales per product with the sum over its last three selling days."""
    days = _total(sales, "prod_id", "time_id")
    framed = days.withColumn("recent", frames.trailing_rows_sum("amount_cents", "time_id", 2, ["prod_id"]))
    return (
        with_calendar(framed, "time_id", "day_name")
        .select(
            "prod_id",
            "time_id",
            "day_name",
            from_cents("amount_cents").alias("daily_sales"),
            from_cents("recent").alias("sum_last_3_days"),
        )
        .orderBy("prod_id", "time_id")
    )


def seven_day_sales(sales: DataFrame) -> DataFrame:
    """Daily sales with the sum over the last seven calendar days, missing days included."""
    days = _total(sales, "time_id")
    framed = days.withColumn("recent", frames.trailing_days_sum("amount_cents", "time_id", 6))
    return (
        with_calendar(framed, "time_id", "day_name")
        .select(
            "time_id",
            "day_name",
            from_cents("amount_cents").alias("daily_sales"),
            from_cents("recent").alias("sales_last_7_calendar_days"),
        )
        .orderBy("time_id")
    )


def promotion_group_sales(sales: DataFrame, promotions: DataFrame) -> DataFrame:
    """Sales per promotion category with the sum over the last three peer groups.

    ``promotions``: promo_id, promo_category_id, promo_category. Categories that share an id are peers.
    """
    totals = _total(
        _total(sales, "promo_id").join(promotions, "promo_id"), "promo_category_id", "promo_category"
    )
    return (
        frames.trailing_groups_sum(totals, "amount_cents", "promo_category_id", 2, "recent")
        .select(
            "promo_category_id",
            "promo_category",
            from_cents("amount_cents").alias("promo_sales"),
            from_cents("recent").alias("sales_last_3_promo_groups"),
        )
        .orderBy("promo_category_id", "promo_category")
    )


def quarter_crosstab(sales: DataFrame, products: DataFrame, category: str, year: int, region: str) -> DataFrame:
    """Product by quarter for one category, year and region, with a year total."""
    chosen = products.filter(F.lower("prod_category") == category.lower()).select("prod_id", "prod_name")
    sold = sales.filter((F.year("time_id") == year) & (F.upper("country_region") == region.upper()))
    # The category is applied to the totals: year and region leave far fewer rows than a filter by product would.
    by_quarter = _total(sold.withColumn("quarter", F.quarter("time_id")), "prod_id", "quarter").join(chosen, "prod_id")
    quarters = ["q1", "q2", "q3", "q4"]
    rows = ["prod_id", "prod_name"]
    table = crosstab(by_quarter, rows, "quarter", [1, 2, 3, 4], "amount_cents", quarters, "year_sum")
    return table.orderBy(F.col("year_sum").desc(), "prod_id").select(
        "prod_id", "prod_name", *[from_cents(c).alias(c) for c in [*quarters, "year_sum"]]
    )


def month_region_pivot(
    sales: DataFrame,
    products: DataFrame,
    year: int,
    months: Sequence[int],
    regions: Mapping[str, str],
) -> DataFrame:
    """Month and category by region as formatted whole amounts; ``regions`` maps column name to region."""
    dated = sales.filter((F.year("time_id") == year) & F.month("time_id").isin(*months))
    sold = dated.filter(F.col("country_region").isin(*regions.values()))
    by_product = _total(
        with_calendar(sold, "time_id", "calendar_month_desc"),
        "calendar_month_desc",
        "prod_id",
        "country_region",
    )
    pivoted = (
        by_product.join(products.select("prod_id", "prod_category"), "prod_id")
        .groupBy("calendar_month_desc", "prod_category")
        .agg(*sums_by_value(F.col("country_region"), F.col("amount_cents"), regions))
    )
    return pivoted.orderBy("calendar_month_desc", "prod_category").select(
        "calendar_month_desc",
        "prod_category",
        *[grouped_number(from_cents(F.col(f"`{name}`"))).alias(name) for name in regions],
    )




def daily_balance(sales: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last sale: the day's sales, the latest day with sales, its sales, and
    the running balance. Days without sales carry the latest values forward."""
    totals = _total(sales, "time_id")
    days = dense_calendar(totals, "time_id", "day").join(totals, F.col("day") == F.col("time_id"), "left")
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per calendar day
    latest = F.last(F.when(F.col("amount_cents").isNotNull(), F.struct("time_id", "amount_cents")), ignorenulls=True)
    carried = days.withColumns({"latest": latest.over(upto), "balance": F.sum("amount_cents").over(upto)})
    return with_calendar(carried, "day", "day_name").orderBy("day").select(
        "day",
        "day_name",
        from_cents(F.coalesce("amount_cents", F.lit(0))).alias("sales"),
        F.col("latest.time_id").alias("last_sales_day"),
        from_cents("latest.amount_cents").alias("last_sales"),
        from_cents("balance").alias("balance"),
    )
