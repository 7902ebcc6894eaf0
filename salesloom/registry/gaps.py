"""Gaps between years, latest rows, row numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.money import cents, from_cents
from salesloom.operators.gaps import adjacent_values
from salesloom.operators.ranking import latest_per_key, nth_row, number_rows, top_dense_ranks
from salesloom.plans import film_rental as reports
from salesloom.registry import query
from salesloom.sources.tables import Tables


def _actor(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("actor_id"), F.col("c_name").alias("actor_name"))


def _years(t: Tables) -> DataFrame:
    """Customers as actors and their orders as films released in the order year."""
    return t.orders.select(F.col("o_custkey").alias("actor_id"), F.year("o_orderdate").alias("release_year"))


@query(
    "inactivity_gap",
    """
SELECT c_custkey AS actor_id, c_name AS actor_name,
       CAST(2001 - MAX(YEAR(o_orderdate)) AS INTEGER) AS inactivity_gap_years
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name
""",
)
def inactivity_gap(t: Tables) -> DataFrame:
    return reports.years_since_last_film(_years(t), _actor(t), 2001)


_YEARS = "y AS (SELECT DISTINCT o_custkey AS k, CAST(YEAR(o_orderdate) AS INTEGER) AS yr FROM orders)"


@query(
    "max_gap_lead",
    f"""
WITH {_YEARS}, pairs AS (
  SELECT k, yr, (SELECT MIN(t2.yr) FROM y t2 WHERE t2.k = t1.k AND t2.yr > t1.yr) AS nxt FROM y t1)
SELECT c_custkey AS actor_id, c_name AS actor_name, MAX(nxt - yr) AS max_gap
FROM pairs JOIN customer ON c_custkey = k WHERE nxt IS NOT NULL GROUP BY c_custkey, c_name
""",
)
def max_gap_lead(t: Tables) -> DataFrame:
    return reports.longest_pause(_years(t), _actor(t))


@query(
    "max_gap_antijoin",
    f"""
WITH {_YEARS}
SELECT c_custkey AS actor_id, c_name AS actor_name, MAX(t2.yr - t1.yr) AS max_gap
FROM y t1 JOIN y t2 USING (k) JOIN customer ON c_custkey = k
WHERE t1.yr < t2.yr
  AND NOT EXISTS (SELECT 1 FROM y t3 WHERE t3.k = t1.k AND t3.yr > t1.yr AND t3.yr < t2.yr)
GROUP BY c_custkey, c_name
""",
)
def max_gap_antijoin(t: Tables) -> DataFrame:
    return reports.longest_pause(_years(t), _actor(t), by_set=True)


@query(
    "adjacent_order_days",
    """
WITH d AS (SELECT DISTINCT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT t1.customer_id, t1.day, t2.day AS next_day
FROM d t1 JOIN d t2 USING (customer_id)
WHERE t1.day < t2.day
  AND NOT EXISTS (SELECT 1 FROM d t3 WHERE t3.customer_id = t1.customer_id AND t3.day > t1.day AND t3.day < t2.day)
""",
)
def adjacent_order_days(t: Tables) -> DataFrame:
    days = t.orders.select(F.col("o_custkey").alias("customer_id"), F.to_date("o_orderdate").alias("day"))
    return adjacent_values(days, "customer_id", "day", "next_day")


_DATED = """
o AS (SELECT o_custkey, o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS closed_on FROM orders)
"""


def _latest(t: Tables, nulls_first: bool) -> DataFrame:
    closed = t.orders.select(
        "o_custkey",
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("closed_on"),
    )
    date = F.col("closed_on")
    order = [date.desc_nulls_first() if nulls_first else date.desc_nulls_last(), F.col("o_orderkey")]
    return latest_per_key(closed, ["o_custkey"], order)


@query(
    "latest_row_per_key",
    f"WITH {_DATED} SELECT DISTINCT ON (o_custkey) * FROM o ORDER BY o_custkey, closed_on DESC NULLS LAST, o_orderkey",
)
def latest_row_per_key(t: Tables) -> DataFrame:
    return _latest(t, nulls_first=False)


@query(
    "latest_row_per_key_nulls_first",
    f"WITH {_DATED} SELECT DISTINCT ON (o_custkey) * FROM o ORDER BY o_custkey, closed_on DESC NULLS FIRST, o_orderkey",
)
def latest_row_per_key_nulls_first(t: Tables) -> DataFrame:
    return _latest(t, nulls_first=True)


@query(
    "numbered_rows",
    """
SELECT ROW_NUMBER() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS row_num, o_orderkey, o_totalprice
FROM orders
""",
)
def numbered_rows(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return number_rows(orders, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()])


@query(
    "nth_row",
    """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(38,2)) AS total FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 1 OFFSET 3
""",
)
def nth_row_by_price(t: Tables) -> DataFrame:
    row = nth_row(t.orders, [F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")], 3)
    return row.select("o_orderkey", "o_custkey", from_cents(cents("o_totalprice")).alias("total"))


@query(
    "dense_rank_with_ties",
    """
WITH counts AS (SELECT o_orderpriority, o_custkey, COUNT(*) AS n FROM orders GROUP BY ALL),
ranked AS (SELECT *, DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY n DESC) AS rn FROM counts)
SELECT o_orderpriority, o_custkey, n, CAST(rn AS INTEGER) AS rn FROM ranked WHERE rn <= 3
""",
)
def dense_rank_with_ties(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority", "o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return top_dense_ranks(counts, ["o_orderpriority"], "n", 3)
