"""Every registered query gives the rows of its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from helpers import canonical, plain
from salesloom import registry
from salesloom.sources.tables import SCHEMAS

ROOT = "/root/testdata/sf0.001"
registry.load_all()
QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in SCHEMAS:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{ROOT}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    expected = duck.execute(ORACLES[name])
    expected_columns = [column[0] for column in expected.description]
    assert canonical(df.columns, df.collect()) == canonical(expected_columns, expected.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert driver.entry(spark).columns == ["channel_desc", "cust_id", "cust_name", "total_sales", "sales_percentage"]


#: The order each report promises, as SQL over its own columns.
ORDERS = {
    "top5_per_channel": "channel_desc, total_sales DESC, cust_id",
    "cohort_all_years": "amount_sold DESC, cust_id, channel_desc",
    "channel_share_yoy": "country_region, calendar_year, channel_desc",
    "weekly_running_centered": "time_id",
    "weekly_running_full_year": "time_id",
    "rolling_range_days": "time_id",
    "rolling_rows": "prod_id, time_id",
    "rolling_groups": "promo_category_id, promo_category",
    "quarter_crosstab": "year_sum DESC, prod_id",
    "month_region_pivot": "calendar_month_desc, prod_category",
    "max_gap_lead": "max_gap DESC, actor_id",
    "inactivity_gap": "inactivity_gap_years DESC NULLS FIRST, actor_id",
    "calendar_dense": "day",
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_the_order_of_the_report(spark, duck, name):
    df = QUERIES[name](spark, ROOT)
    expected = duck.execute(f"SELECT * FROM ({ORACLES[name]}) ORDER BY {ORDERS[name]}")
    places = [df.columns.index(column[0]) for column in expected.description]
    found = [tuple(plain(row[i]) for i in places) for row in df.collect()]
    assert found == [tuple(map(plain, row)) for row in expected.fetchall()]
