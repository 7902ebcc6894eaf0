"""The test tables in the roles the reports expect.

Sales star: a line item is a sale, its order gives customer, date and channel (the order priority).
Rental shop: a part is a film, a (part, supplier) pair is a copy, a line item is a rental and its order the
payment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.dates import in_window
from salesloom.functions.money import cents
from salesloom.sources.tables import Tables


def dated_orders(t: Tables, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Orders in the half-open date window, cut on the raw column so the scan can skip row groups."""
    orders = t.orders.filter(in_window(F.col("o_orderdate"), start, end))
    return orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("cust_id"),
        F.to_date("o_orderdate").alias("time_id"),
        F.col("o_orderpriority").alias("channel_desc"),
    )


def regional_orders(t: Tables, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Orders with country and region of their customer.

    Places are attached to the orders, before the lines: the line table never has to be shuffled by customer.
    """
    return dated_orders(t, start, end).join(customers(t).drop("cust_name"), "cust_id")


def national_orders(t: Tables) -> DataFrame:
    """Orders (l_orderkey) with the country of their customer, for reports that need no region."""
    nations = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nations, "c_nationkey")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return orders.join(customers, "o_custkey").select("l_orderkey", "country")


def sales_lines(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Sales at line grain with the columns of ``orders`` (default: all dated orders)."""
    lines = t.lineitem.select(
        "l_orderkey", F.col("l_partkey").alias("prod_id"), cents("l_extendedprice").alias("amount_cents")
    )
    return lines.join(dated_orders(t) if orders is None else orders, "l_orderkey").drop("l_orderkey")


def sales_by_order(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Sales at order grain, for reports that need no product: lines are totalled before they meet the order."""
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.sum(cents("l_extendedprice")).alias("amount_cents"))
    return per_order.join(dated_orders(t) if orders is None else orders, "l_orderkey").drop("l_orderkey")


def customers(t: Tables) -> DataFrame:
    """Customers with the nation and region they live in."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("cust_id"),
        F.col("c_name").alias("cust_name"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("country_region"),
    )


def customer_names(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("cust_name"))


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("prod_category"),
    )


def promotions(t: Tables) -> DataFrame:
    """Promotion categories: the size of a part is the category id, so several part types are peers."""
    return t.part.select(
        F.col("p_partkey").alias("promo_id"),
        F.col("p_size").alias("promo_category_id"),
        F.col("p_type").alias("promo_category"),
    )


def film(t: Tables) -> DataFrame:
    """Parts as films: title, language and release year come from name, type and size."""
    return t.part.select(
        F.col("p_partkey").alias("film_id"),
        F.concat_ws(" ", "p_name", "p_brand").alias("title"),
        F.col("p_type").alias("language"),
        F.col("p_type").alias("rating"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("length"),
        (F.col("p_size") + 1970).alias("release_year"),
        (F.col("p_size") * 100).cast("bigint").alias("rental_rate_cents"),
        F.col("p_size").alias("rental_duration"),
        cents("p_retailprice").alias("replacement_cents"),
    )


def film_supplier(t: Tables) -> DataFrame:
    """Suppliers as actors: each (supplier, part) pair that was ever delivered, once."""
    return t.lineitem.select(F.col("l_suppkey").alias("actor_id"), F.col("l_partkey").alias("film_id")).distinct()


def payments(t: Tables) -> DataFrame:
    """Line items as payments made on the order date in the store of the supplier."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("payment_date"),
    )
    lines = t.lineitem.select(
        "l_orderkey",
        F.col("l_partkey").alias("film_id"),
        F.col("l_suppkey").alias("store_id"),
        cents("l_extendedprice").alias("amount_cents"),
    )
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def order_payments(t: Tables) -> DataFrame:
    """Orders as payments of their customer."""
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("payment_date"),
        cents("o_totalprice").alias("amount_cents"),
    )


def _copy() -> Column:
    return F.struct("l_partkey", "l_suppkey")


def rentals(t: Tables) -> DataFrame:
    """Line items as rentals: out on the order date, back on the ship date, still out while the line is open."""
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("rental_date"),
    )
    lines = t.lineitem.select(
        "l_orderkey",
        F.col("l_partkey").alias("film_id"),
        _copy().alias("inventory_id"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("return_date"),
        F.col("l_returnflag").alias("kind"),
    )
    return lines.join(orders, "l_orderkey").drop("l_orderkey")


def inventory(t: Tables) -> DataFrame:
    """Copies: one per (part, supplier) pair."""
    return t.lineitem.select("l_partkey", "l_suppkey").distinct().select(
        _copy().alias("inventory_id"), F.col("l_partkey").alias("film_id")
    )


def stores(t: Tables) -> DataFrame:
    """Suppliers as stores; the second address line is missing where the balance is negative or small."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("address"),
        F.when(F.col("s_acctbal") >= 1000, F.col("n_name")).alias("address2"),
    )
