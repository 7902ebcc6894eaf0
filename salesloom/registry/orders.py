"""Order book: latest quarter, transactions by natural keys, field changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.money import cents, from_cents
from salesloom.plans import retail_orders as book
from salesloom.registry import query
from salesloom.sources.tables import Tables


@query(
    "recent_quarter_report",
    """
WITH latest AS (SELECT DATE_TRUNC('quarter', MAX(o_orderdate)) AS q FROM orders)
SELECT STRFTIME(q, '%Y') || '-Q' || QUARTER(q) AS quarter_label, c_name AS customer_name,
       CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
       SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS order_total
FROM orders CROSS JOIN latest JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey
WHERE o_orderdate >= q AND o_orderdate < q + INTERVAL '3 months'
GROUP BY ALL
""",
)
def recent_quarter_report(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )
    details = t.lineitem.select(F.col("l_orderkey").alias("order_id"), cents("l_extendedprice").alias("line_total"))
    customer = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"))
    report = book.recent_quarter_report(orders, details, customer)
    return report.withColumn("order_total", from_cents("order_total"))


def _book(t: Tables) -> dict[str, DataFrame]:
    """Orders dated into the years the order book accepts, suppliers as employees, parts as products."""
    return {
        "orders": t.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").cast("int").alias("customer_id"),
            F.lit(0).alias("employee_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
        ),
        "order_detail": t.lineitem.select(F.col("l_linenumber").alias("order_detail_id")),
        "customer": t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("email")),
        "employee": t.supplier.select(F.col("s_suppkey").alias("employee_id"), F.col("s_name").alias("emp_name")),
        "product": t.part.select(
            F.col("p_partkey").alias("product_id"),
            F.concat_ws(" ", "p_name", "p_brand").alias("product_name"),
            from_cents(cents("p_retailprice")).cast("decimal(10,2)").alias("unit_price"),
        ),
    }


def _batch(t: Tables) -> DataFrame:
    """One new transaction per order, by names; its first line gives the product, the supplier and the quantity.

    Large pending orders name nobody, some quantities are not positive, low-priority orders come without
    status, urgent ones without date, medium ones without price.
    """
    lines = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("part"), F.max("l_suppkey").alias("supp"), F.sum("l_quantity").alias("pieces")
    )
    named = lines.join(t.part, F.col("part") == F.col("p_partkey"))
    named = named.join(t.supplier, F.col("supp") == F.col("s_suppkey"))
    priority = F.col("o_orderpriority")
    unknown = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 400000)
    return (
        t.orders.join(named, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("batch_id"),
            F.when(unknown, F.lit("nobody")).otherwise(F.col("c_name")).alias("customer_email"),
            F.col("s_name").alias("employee_name"),
            F.concat_ws(" ", "p_name", "p_brand").alias("product_name"),
            (F.col("pieces") - 10).cast("int").alias("quantity"),
            F.when(priority != "1-URGENT", F.to_date("o_orderdate")).alias("order_date"),
            F.when(priority != "5-LOW", F.lit("Completed")).alias("order_status"),
            F.when(priority != "3-MEDIUM", from_cents(cents("o_totalprice"))).cast("decimal(10,2)").alias("unit_price"),
        )
    )


_TRANSACTIONS = """
WITH lines AS (SELECT l_orderkey, MIN(l_partkey) AS part, MAX(l_suppkey) AS supp, SUM(l_quantity) AS pieces
               FROM lineitem GROUP BY l_orderkey),
product AS (SELECT p_name || ' ' || p_brand AS product_name, MIN(p_partkey) AS product_id FROM part GROUP BY 1),
batch AS (
  SELECT o_orderkey AS batch_id,
         CASE WHEN o_orderstatus = 'P' AND o_totalprice > 400000 THEN 'nobody' ELSE c_name END AS customer_email,
         s_name AS employee_name, p_name || ' ' || p_brand AS product_name, CAST(pieces - 10 AS INTEGER) AS quantity,
         CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) ELSE DATE '2001-12-31' END AS order_date,
         CASE WHEN o_orderpriority <> '5-LOW' THEN 'Completed' ELSE 'Pending' END AS order_status,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS own_price
  FROM orders JOIN lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON part = p_partkey JOIN supplier ON supp = s_suppkey),
checked AS (
  SELECT batch.*, c_custkey AS customer_id, s_suppkey AS employee_id, product_id,
         CASE WHEN c_custkey IS NULL THEN 'customer_email not found' WHEN quantity <= 0 THEN 'quantity must be positive'
              WHEN order_date < DATE '1995-06-01' THEN 'order_date too early' END AS reject_reason
  FROM batch LEFT JOIN customer ON customer_email = c_name LEFT JOIN supplier ON employee_name = s_name
       LEFT JOIN product USING (product_name))
"""


def _transactions(t: Tables) -> book.Transactions:
    tables = _book(t)
    return book.add_transactions(
        tables["orders"],
        tables["order_detail"],
        tables["customer"],
        tables["employee"],
        tables["product"],
        _batch(t),
        as_of=dt.date(2001, 12, 31),
        first_date=dt.date(1995, 6, 1),
    )


@query(
    "add_transactions",
    f"""{_TRANSACTIONS}, numbered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY batch_id) AS n FROM checked WHERE reject_reason IS NULL)
SELECT (SELECT MAX(o_orderkey) FROM orders) + n AS order_id, customer_id, employee_id, order_date, order_status,
       (SELECT MAX(l_linenumber) FROM lineitem) + n AS order_detail_id, product_id, quantity,
       COALESCE(own_price, CAST(p_retailprice AS DECIMAL(10,2))) AS unit_price,
       CAST(quantity * COALESCE(own_price, CAST(p_retailprice AS DECIMAL(10,2))) AS DECIMAL(12,2)) AS line_total
FROM numbered JOIN part ON product_id = p_partkey
""",
)
def add_transactions(t: Tables) -> DataFrame:
    added = _transactions(t)
    return added.orders.join(added.details, "order_id")


@query(
    "add_transactions_rejects",
    f"{_TRANSACTIONS} SELECT batch_id, reject_reason FROM checked WHERE reject_reason IS NOT NULL",
)
def add_transactions_rejects(t: Tables) -> DataFrame:
    return _transactions(t).rejects.select("batch_id", "reject_reason")


@query(
    "field_changes",
    """
SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, 0 AS employee_id,
       CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'O' THEN DATE '2024-02-01'
            ELSE CAST(o_orderdate AS DATE) END AS order_date,
       CASE WHEN o_totalprice > 450000 THEN 'Cancelled' WHEN o_orderstatus = 'P' THEN 'Shipped'
            ELSE o_orderstatus END AS order_status
FROM orders
""",
)
def field_changes(t: Tables) -> DataFrame:
    def change(rows, column: str, value: str, sequence: int) -> DataFrame:
        return t.orders.filter(rows).select(
            F.col("o_orderkey").alias("order_id"),
            F.lit(column).alias("column_name"),
            F.lit(value).alias("new_value"),
            F.lit(sequence).alias("sequence"),
        )

    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    changes = (
        change(F.col("o_orderstatus") == "P", "order_status", "Shipped", 1)
        .unionByName(change(F.col("o_totalprice") > 450000, "order_status", "Cancelled", 2))
        .unionByName(change(urgent, "order_date", "2024-02-01", 1))
    )
    tables = _book(t)
    return book.change_order_fields(tables["orders"], changes, tables["customer"], tables["employee"]).orders


@query(
    "field_changes_rejects",
    """
WITH asked AS (
  SELECT o_orderkey AS order_id,
         CASE o_orderkey % 7 WHEN 0 THEN 'customer_id' WHEN 1 THEN 'customer_id' WHEN 2 THEN 'order_status'
           WHEN 3 THEN 'order_date' WHEN 4 THEN 'order_date' WHEN 5 THEN 'note' ELSE 'order_status' END AS column_name,
         CASE o_orderkey % 7 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN CAST(o_custkey + 100000000 AS VARCHAR)
           WHEN 2 THEN 'Bogus' WHEN 3 THEN 'soon' WHEN 4 THEN '1990-01-01' WHEN 5 THEN 'x' END AS new_value
  FROM orders)
SELECT order_id, column_name, new_value,
       CASE WHEN column_name = 'note' THEN 'column cannot be changed'
            WHEN new_value IS NULL THEN 'value must not be NULL'
            WHEN new_value = 'soon' THEN 'value does not fit the type'
            WHEN column_name = 'order_date' THEN 'order_date too early'
            WHEN column_name = 'order_status' THEN 'order_status not allowed'
            ELSE 'customer_id not found' END AS reject_reason
FROM asked
WHERE NOT (column_name = 'customer_id' AND TRY_CAST(new_value AS BIGINT) IN (SELECT c_custkey FROM customer))
""",
)
def field_changes_rejects(t: Tables) -> DataFrame:
    kind = F.pmod("o_orderkey", F.lit(7))
    columns = ("customer_id", "customer_id", "order_status", "order_date", "order_date", "note", "order_status")
    customer = F.col("o_custkey")
    values = (customer.cast("string"), (customer + 100_000_000).cast("string"), "Bogus", "soon", "1990-01-01", "x", None)

    def chosen(options) -> Column:
        options = [o if isinstance(o, Column) else F.lit(o).cast("string") for o in options]
        return F.element_at(F.array(*options), (kind + 1).cast("int"))

    changes = t.orders.select(
        F.col("o_orderkey").alias("order_id"),
        chosen(columns).alias("column_name"),
        chosen(values).alias("new_value"),
        F.lit(1).alias("sequence"),
    )
    tables = _book(t)
    found = book.change_order_fields(tables["orders"], changes, tables["customer"], tables["employee"])
    return found.rejects.drop("sequence")


@query(
    "orders_of_customer",
    """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
       s_name AS handled_by
FROM orders JOIN customer ON o_custkey = c_custkey JOIN supplier ON s_suppkey = o_orderkey % 10
WHERE c_name = 'Customer#000000007'
""",
)
def orders_of_customer(t: Tables) -> DataFrame:
    tables = _book(t)
    handled = tables["orders"].withColumn("employee_id", F.pmod("order_id", F.lit(10)))
    return book.orders_of_customer(handled, tables["customer"], tables["employee"], "Customer#000000007")
