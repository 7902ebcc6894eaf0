"""Rental shop: revenue, top lists, labels, stock, balances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.dates import in_years
from salesloom.functions.money import cents
from salesloom.plans import film_rental as reports
from salesloom.registry import query
from salesloom.sources import roles
from salesloom.sources.tables import Tables
from salesloom.sources.views import create_views

_CATEGORY_ORACLE = """
SELECT CAST(o_orderkey AS VARCHAR) AS title
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE LOWER(n_name) = 'nation_7' AND YEAR(o_orderdate) BETWEEN 1997 AND 1999 AND o_totalprice > 100000
"""


def _category_list(t: Tables, by_membership: bool) -> DataFrame:
    film = t.orders.filter(in_years(F.col("o_orderdate"), 1997, 1999)).select(
        F.col("o_orderkey").cast("string").alias("title"),
        F.col("o_custkey").alias("film_id"),
        F.year("o_orderdate").alias("release_year"),
        F.col("o_totalprice").alias("rental_rate"),
    )
    bridge = t.customer.select(F.col("c_custkey").alias("film_id"), F.col("c_nationkey").alias("category_id"))
    category = t.nation.select(F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("name"))
    return reports.titles_in_category(film, bridge, category, "Nation_7", (1997, 1999), 100000, by_membership)


@query("category_list", _CATEGORY_ORACLE)
def category_list(t: Tables) -> DataFrame:
    return _category_list(t, by_membership=False)


@query("category_list_semi", _CATEGORY_ORACLE)
def category_list_semi(t: Tables) -> DataFrame:
    return _category_list(t, by_membership=True)


_STORE_ORACLE = """
SELECT s_suppkey AS store_id, CONCAT_WS(', ', s_name, CASE WHEN s_acctbal >= 1000 THEN n_name END) AS store_address,
       SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey
WHERE o_orderdate >= TIMESTAMP '1998-04-01'
GROUP BY ALL
"""


@query("revenue_by_store", _STORE_ORACLE)
def revenue_by_store(t: Tables) -> DataFrame:
    return reports.revenue_by_store(roles.payments(t), roles.stores(t), dt.date(1998, 4, 1), aggregate_first=False)


@query("revenue_by_store_preagg", _STORE_ORACLE)
def revenue_by_store_preagg(t: Tables) -> DataFrame:
    return reports.revenue_by_store(roles.payments(t), roles.stores(t), dt.date(1998, 4, 1))


@query(
    "top_suppliers_by_parts",
    """
SELECT s_suppkey AS actor_id, s_name AS actor_name, COUNT(*) AS number_of_movies
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey
     JOIN supplier ON s_suppkey = l_suppkey
WHERE p_size + 1970 > 2015
GROUP BY ALL ORDER BY number_of_movies DESC, actor_id LIMIT 5
""",
)
def top_suppliers_by_parts(t: Tables) -> DataFrame:
    actor = t.supplier.select(F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("actor_name"))
    return reports.busiest_actors(roles.film_supplier(t), roles.film(t), actor, 2015)


@query(
    "top_staff_revenue",
    """
SELECT s_suppkey AS staff_id, s_name AS staff_name, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total_revenue,
       CONCAT_WS(', ', n_name, r_name) AS last_store_address
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
WHERE YEAR(l_shipdate) = 1997
GROUP BY ALL ORDER BY total_revenue DESC, staff_id LIMIT 3
""",
)
def top_staff_revenue(t: Tables) -> DataFrame:
    payments = t.lineitem.select(
        F.col("l_suppkey").alias("staff_id"),
        F.col("l_shipdate").alias("payment_date"),
        cents("l_extendedprice").alias("amount_cents"),
    )
    place = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    staff = t.supplier.join(place, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("staff_id"),
        F.col("s_name").alias("staff_name"),
        F.col("n_name").alias("address"),
        F.col("r_name").alias("address2"),
    )
    return reports.best_staff(payments, staff, 1997)


PART_LABELS = {
    "ECONOMY": "Budget range",
    "STANDARD": "Everyday range",
    "PROMO": "Special offers",
    "LARGE": "Bulky goods",
}


@query(
    "top_parts_with_label",
    """
SELECT p_partkey AS film_id, p_name || ' ' || p_brand AS title, COUNT(*) AS number_of_rentals,
       CASE p_type WHEN 'ECONOMY' THEN 'Budget range' WHEN 'STANDARD' THEN 'Everyday range'
                   WHEN 'PROMO' THEN 'Special offers' WHEN 'LARGE' THEN 'Bulky goods'
                   ELSE 'Not Rated' END AS expected_audience
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_partkey, p_name, p_brand, p_type ORDER BY number_of_rentals DESC, film_id LIMIT 5
""",
)
def top_parts_with_label(t: Tables) -> DataFrame:
    rentals = t.lineitem.select(F.col("l_partkey").alias("film_id"))
    return reports.most_rented(rentals, roles.film(t), labels=PART_LABELS)


_GENRES = {"asian_orders": "Asia", "european_orders": "Europe", "african_orders": "Africa"}

_GENRE_ORACLE = """
SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS release_year,
       COUNT(CASE WHEN LOWER(r_name) = 'asia' THEN 1 END) AS asian_orders,
       COUNT(CASE WHEN LOWER(r_name) = 'europe' THEN 1 END) AS european_orders,
       COUNT(CASE WHEN LOWER(r_name) = 'africa' THEN 1 END) AS african_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
     LEFT JOIN region ON n_regionkey = r_regionkey
GROUP BY 1
"""

_GENRE_CORRELATED_ORACLE = """
WITH f AS (SELECT CAST(YEAR(o_orderdate) AS INTEGER) AS y, LOWER(r_name) AS genre
           FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)
SELECT y AS release_year, (SELECT COUNT(*) FROM f WHERE genre = 'asia' AND f.y = o.y) AS asian_orders,
       (SELECT COUNT(*) FROM f WHERE genre = 'europe' AND f.y = o.y) AS european_orders,
       (SELECT COUNT(*) FROM f WHERE genre = 'africa' AND f.y = o.y) AS african_orders
FROM (SELECT DISTINCT CAST(YEAR(o_orderdate) AS INTEGER) AS y FROM orders) o
"""


def _genre_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    film = t.orders.select(F.col("o_custkey").alias("film_id"), F.year("o_orderdate").alias("release_year"))
    bridge = t.customer.select(F.col("c_custkey").alias("film_id"), F.col("c_nationkey").alias("category_id"))
    category = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("category_id"), F.col("r_name").alias("name")
    )
    return film, bridge, category


@query("genre_pivot", _GENRE_ORACLE)
def genre_pivot(t: Tables) -> DataFrame:
    return reports.genre_counts_by_year(*_genre_tables(t), _GENRES)


@query("genre_pivot_correlated", _GENRE_CORRELATED_ORACLE)
def genre_pivot_correlated(t: Tables) -> DataFrame:
    return reports.genre_counts_by_lookup(*_genre_tables(t), _GENRES)


@query(
    "quarter_category_revenue",
    """
SELECT p_type AS category, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total_sales_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE YEAR(o_orderdate) = 1998 AND QUARTER(o_orderdate) = QUARTER(DATE '1998-05-17')
GROUP BY p_type HAVING SUM(CAST(l_extendedprice AS DECIMAL(12,2))) > 0
""",
)
def quarter_category_revenue(t: Tables) -> DataFrame:
    categories = roles.film(t).select("film_id", F.col("rating").alias("category"))
    return reports.category_revenue_in_quarter(roles.payments(t), categories, dt.date(1998, 5, 17))


@query(
    "quarter_revenue_view",
    """
SELECT p_type AS category, SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS total_sales_revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
WHERE YEAR(o_orderdate) = 1998 AND QUARTER(o_orderdate) = 2 AND p_type LIKE '%O%'
GROUP BY p_type
""",
)
def quarter_revenue_view(t: Tables) -> DataFrame:
    create_views({"sales_revenue_by_category_quarter": quarter_category_revenue(t)})
    return t.spark.sql("SELECT * FROM sales_revenue_by_category_quarter WHERE category LIKE '%O%'")


@query(
    "popular_part_per_nation",
    """
WITH counted AS (
  SELECT n_name AS country, p_name || ' ' || p_brand AS title, p_type AS rating, p_type AS language, p_size AS length,
         p_size + 1970 AS release_year, COUNT(*) AS rental_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
  WHERE n_name ILIKE 'nation%' GROUP BY ALL),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY country
                     ORDER BY rental_count DESC, title, rating, language, length, release_year) AS rn FROM counted)
SELECT country, title, rating, language, length, release_year, rental_count FROM ranked WHERE rn = 1
""",
)
def popular_part_per_nation(t: Tables) -> DataFrame:
    orders = roles.national_orders(t)
    rentals = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("film_id")).join(orders, "l_orderkey")
    countries = t.nation.select(F.col("n_name").alias("country"))
    film_columns = ["title", "rating", "language", "length", "release_year"]
    return reports.most_popular_by_country(
        rentals, roles.film(t), countries, "nation%", film_columns, renters=orders.select("country")
    )


def _stock_oracle(pattern: str, nulls: str) -> str:
    return f"""
WITH copies AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
rent AS (
  SELECT l_partkey, l_suppkey, o_custkey, o_orderdate AS rental_date, l_linestatus = 'O' AS is_out
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
picked AS (
  SELECT DISTINCT ON (title) p_name || ' ' || p_brand AS title, p_type AS language, c_name, rental_date
  FROM part JOIN copies ON copies.l_partkey = p_partkey
       LEFT JOIN rent ON rent.l_partkey = copies.l_partkey AND rent.l_suppkey = copies.l_suppkey
       LEFT JOIN customer ON c_custkey = o_custkey
  WHERE p_name || ' ' || p_brand ILIKE '{pattern}'
    AND (SELECT COUNT(*) FROM copies c2 WHERE c2.l_partkey = p_partkey)
        > (SELECT COUNT(*) FROM rent r2 WHERE r2.l_partkey = p_partkey AND is_out)
  ORDER BY title, rental_date DESC NULLS {nulls}, o_custkey DESC NULLS LAST, p_partkey),
numbered AS (
  SELECT ROW_NUMBER() OVER (ORDER BY title) AS row_num, title AS film_title, language,
         COALESCE(c_name, '') AS customer_name, rental_date FROM picked)
SELECT * FROM numbered
UNION ALL
SELECT 1, 'No films in stock matching pattern: {pattern}', NULL, NULL, NULL
WHERE NOT EXISTS (SELECT 1 FROM numbered)
"""


def _in_stock(t: Tables, pattern: str, never_rented_first: bool = False) -> DataFrame:
    rental = roles.rentals(t)
    customer = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"))
    return reports.in_stock_by_title(
        roles.film(t), roles.inventory(t), rental, customer, pattern, never_rented_first
    )


@query("in_stock_by_title", _stock_oracle("%ring brand#1%", "LAST"))
def in_stock_by_title(t: Tables) -> DataFrame:
    return _in_stock(t, "%ring brand#1%")


@query("in_stock_by_title_as_written", _stock_oracle("%ring brand#1%", "FIRST"))
def in_stock_by_title_as_written(t: Tables) -> DataFrame:
    return _in_stock(t, "%ring brand#1%", never_rented_first=True)


@query("in_stock_by_title_no_match", _stock_oracle("%no such title%", "LAST"))
def in_stock_by_title_no_match(t: Tables) -> DataFrame:
    return _in_stock(t, "%no such title%")


@query(
    "loyal_customers",
    """
SELECT c_custkey AS customer_id, c_name, c_nationkey, c_mktsegment FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders
  WHERE o_orderdate >= TIMESTAMP '2000-02-01' AND o_orderdate < TIMESTAMP '2000-05-01'
  GROUP BY o_custkey HAVING COUNT(*) > 1 AND SUM(CAST(o_totalprice AS DECIMAL(12,2))) > 250000)
""",
)
def loyal_customers(t: Tables) -> DataFrame:
    customer = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name", "c_nationkey", "c_mktsegment")
    return reports.loyal_customers(roles.order_payments(t), customer, 1, 250_000_00, dt.date(2000, 5, 1))


@query(
    "high_activity",
    """
SELECT c_custkey AS customer_id, c_name,
       (SELECT COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) AS rentals,
       (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS payments
FROM customer
WHERE (SELECT COUNT(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) >= 43
  AND (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) >= 12
ORDER BY rentals DESC, payments DESC, customer_id LIMIT 5
""",
)
def high_activity(t: Tables) -> DataFrame:
    customer = t.customer.select(F.col("c_custkey").alias("customer_id"), "c_name")
    rentals = roles.rentals(t).select("customer_id")
    return reports.high_activity_customers(customer, rentals, roles.order_payments(t), 43, 12, k=5)


def _balance_oracle(late: str) -> str:
    return f"""
WITH owed AS (
  SELECT o_custkey, SUM(CAST(p_size AS DECIMAL(12,2))) AS rent, SUM(
    CASE WHEN l_linestatus <> 'O' AND DATE_DIFF('day', o_orderdate, l_shipdate) > p_size
         THEN CAST(DATE_DIFF('day', o_orderdate, l_shipdate) - p_size AS DECIMAL(12,2)) ELSE 0 END
    + CASE WHEN DATE_DIFF('day', o_orderdate,
                          CASE WHEN l_linestatus <> 'O' THEN l_shipdate ELSE TIMESTAMP '2000-06-30' END) > p_size * 2
           THEN CAST(p_retailprice AS DECIMAL(12,2)) ELSE 0 END) AS late
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate <= TIMESTAMP '2000-06-30' GROUP BY o_custkey),
paid AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS paid FROM orders
         WHERE o_orderdate <= TIMESTAMP '2000-06-30' GROUP BY o_custkey),
parts AS (
  SELECT c_custkey AS customer_id, COALESCE(rent, 0) AS rent_fees, CAST({late} AS DECIMAL(38,2)) AS late_fees,
         COALESCE(paid, 0) AS payments
  FROM customer LEFT JOIN owed ON owed.o_custkey = c_custkey LEFT JOIN paid ON paid.o_custkey = c_custkey)
SELECT *, rent_fees + late_fees - payments AS balance FROM parts
"""


def _balances(t: Tables, **options) -> DataFrame:
    customer = t.customer.select(F.col("c_custkey").alias("customer_id"))
    film = roles.film(t).select("film_id", "rental_rate_cents", "rental_duration", "replacement_cents")
    return reports.customer_balances(
        customer, roles.rentals(t), film, roles.order_payments(t), dt.date(2000, 6, 30), **options
    )


@query("customer_balance", _balance_oracle("COALESCE(late, 0)"))
def customer_balance(t: Tables) -> DataFrame:
    return _balances(t)


@query("customer_balance_rounded", _balance_oracle("ROUND(COALESCE(late, 0), 0)"))
def customer_balance_rounded(t: Tables) -> DataFrame:
    return _balances(t, round_late_fees=True)
