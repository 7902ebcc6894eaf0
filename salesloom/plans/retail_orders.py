"""Order book: transactions by natural keys, field changes, latest-quarter report.

Tables have the shapes declared in ``salesloom.sources.declared``.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.derived import line_total
from salesloom.functions.text import quarter_label, require_text
from salesloom.operators.changes import apply_field_changes, assign_keys, highest_key
from salesloom.operators.lookup import in_set, resolve_keys, split_rejects

# The states an order can be in, the state of a new one, and the first allowed order date.
ORDER_STATUS = ("Pending", "Shipped", "Completed", "Cancelled")
NEW_ORDER_STATUS = "Pending"
FIRST_ORDER_DATE = dt.date(2024, 1, 1)

# Order columns that may be changed by name, with their types.
CHANGEABLE = {"customer_id": "int", "employee_id": "int", "order_date": "date", "order_status": "string"}


class Transactions:
    """Rejects are planned at once; the accepted rows are numbered and frozen when first asked for."""

    def __init__(self, rejects: DataFrame, accepted: Callable[[], tuple[DataFrame, DataFrame]]):
        self.rejects = rejects
        self._accepted = functools.cache(accepted)

    @property
    def orders(self) -> DataFrame:
        return self._accepted()[0]

    @property
    def details(self) -> DataFrame:
        return self._accepted()[1]


def add_transactions(
    orders: DataFrame,
    order_detail: DataFrame,
    customer: DataFrame,
    employee: DataFrame,
    product: DataFrame,
    batch: DataFrame,
    as_of: dt.date,
    first_date: dt.date = FIRST_ORDER_DATE,
) -> Transactions:
    """One order with one detail line per row of ``batch``, keys looked up by natural key.

    ``batch``: batch_id (unique), customer_email, employee_name, product_name, quantity, order_date,
    order_status, unit_price; missing date, status and price mean today, pending and the product's price.
    Rows with an unknown key or a value outside the table rules come back as rejects with the reason.
    """
    resolved = resolve_keys(
        batch,
        {
            "customer_email": (customer, "email", "customer_id", "customer_id"),
            "employee_name": (employee, "emp_name", "employee_id", "employee_id"),
            "product_name": (
                product.select("product_name", F.struct("product_id", "unit_price").alias("_product")),
                "product_name",
                "_product",
                "_product",
            ),
        },
    ).withColumns({"product_id": F.col("_product.product_id"), "_list_price": F.col("_product.unit_price")})
    filled = resolved.withColumns(
        {
            "order_date": F.coalesce("order_date", F.lit(as_of)),
            "order_status": F.coalesce("order_status", F.lit(NEW_ORDER_STATUS)),
            "_price": F.coalesce(F.col("unit_price"), F.col("_list_price")).try_cast("decimal(10,2)"),
        }
    )
    total = F.try_multiply(F.col("quantity").cast("decimal(38,2)"), F.col("_price").cast("decimal(38,2)"))
    reason = (
        F.when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .when(F.coalesce(F.col("quantity"), F.lit(0)) <= 0, F.lit("quantity must be positive"))
        .when(F.col("order_date") < F.lit(first_date), F.lit("order_date too early"))
        .when(~F.col("order_status").isin(*ORDER_STATUS), F.lit("order_status not allowed"))
        .when(F.col("_price").isNull(), F.lit("unit_price does not fit"))
        .when(total.try_cast("decimal(12,2)").isNull(), F.lit("line_total does not fit"))
    )
    accepted, rejects = split_rejects(filled.withColumn("reject_reason", reason))
    rejects = rejects.drop("_product", "_list_price", "_price")
    priced = accepted.withColumn("unit_price", F.col("_price")).drop("_product", "_list_price", "_price")

    def numbered() -> tuple[DataFrame, DataFrame]:
        top_order, top_detail = highest_key(orders, "order_id"), highest_key(order_detail, "order_detail_id")
        headers = assign_keys(orders, priced, "order_id", [F.col("batch_id")], top_order)
        # One line per header, numbered in the same order: the header key minus the highest old one is its rank.
        details = headers.select(
            (F.col("order_id") - top_order + top_detail).alias("order_detail_id"),
            "order_id",
            "product_id",
            "quantity",
            "unit_price",
            line_total().alias("line_total"),
        )
        return headers.select("order_id", "customer_id", "employee_id", "order_date", "order_status"), details

    return Transactions(rejects, numbered)


class FieldChanges(NamedTuple):
    orders: DataFrame
    rejects: DataFrame


def change_order_fields(
    orders: DataFrame,
    changes: DataFrame,
    customer: DataFrame,
    employee: DataFrame,
    first_date: dt.date = FIRST_ORDER_DATE,
) -> FieldChanges:
    """Apply (order_id, column_name, new_value, sequence) rows to the order book.

    A change of another column, a value of the wrong type, a NULL, a value that breaks the table's rules, an unknown
    customer or employee and an unknown order come back as rejects with the reason; the other changes take effect.
    """

    def typed(column: str) -> Column:
        return F.when(F.col("column_name") == column, F.col("new_value").try_cast(CHANGEABLE[column]))

    def known(parent: DataFrame, key: str, mark: str) -> DataFrame:
        return parent.select(F.col(key).alias(mark)).filter(F.col(mark).isNotNull()).distinct()

    checked = changes.withColumns({"_customer": typed("customer_id"), "_employee": typed("employee_id")})
    for parent, key, mark in (
        (customer, "customer_id", "_customer"),
        (employee, "employee_id", "_employee"),
        (orders, "order_id", "order_id"),
    ):
        members = known(parent, key, mark).withColumn(f"{mark}_found", F.lit(True))
        checked = checked.join(members, mark, "left")
    column = F.col("column_name")
    fits = F.coalesce(*[typed(c).cast("string") for c in CHANGEABLE])
    reason = (
        F.when(~F.coalesce(column.isin(*CHANGEABLE), F.lit(False)), F.lit("column cannot be changed"))
        .when(F.col("order_id_found").isNull(), F.lit("order_id not found"))
        .when(F.col("new_value").isNull(), F.lit("value must not be NULL"))
        .when(fits.isNull(), F.lit("value does not fit the type"))
        .when(typed("order_date") < F.lit(first_date), F.lit("order_date too early"))
        .when(~typed("order_status").isin(*ORDER_STATUS), F.lit("order_status not allowed"))
        .when((column == "customer_id") & F.col("_customer_found").isNull(), F.lit("customer_id not found"))
        .when((column == "employee_id") & F.col("_employee_found").isNull(), F.lit("employee_id not found"))
    )
    accepted, rejects = split_rejects(checked.withColumn("reject_reason", reason).select(*changes.columns, "reject_reason"))
    return FieldChanges(apply_field_changes(orders, accepted, "order_id", CHANGEABLE, "sequence"), rejects)


def orders_of_customer(orders: DataFrame, customer: DataFrame, employee: DataFrame, email: str) -> DataFrame:
    """The orders of one customer, newest first, with the employee who handled them."""
    mine = customer.filter(F.col("email") == require_text(email, "email")).select("customer_id")
    return (
        orders.join(mine, "customer_id")
        .join(employee.select("employee_id", F.col("emp_name").alias("handled_by")), "employee_id")
        .select("order_id", "order_date", "order_status", "handled_by")
        .orderBy(F.col("order_date").desc_nulls_first(), "order_id")
    )


def recent_quarter_report(orders: DataFrame, order_detail: DataFrame, customer: DataFrame) -> DataFrame:
    """Totals by customer, day and status in the latest quarter that has orders.

    Two orders of one customer on one day in one state share a row. ``order_date`` may be a date or a
    timestamp without zone; ``order_detail`` gives line_total.
    """
    raw = orders.schema["order_date"].dataType.simpleString()
    start = F.date_trunc("quarter", F.max("order_date")).cast("date")
    bounds = orders.agg(
        F.struct(start.cast(raw).alias("first"), F.add_months(start, 3).cast(raw).alias("after")).alias("d")
    ).scalar()
    recent = orders.filter((F.col("order_date") >= bounds["first"]) & (F.col("order_date") < bounds["after"]))
    details = in_set(order_detail.select("order_id", "line_total"), recent, "order_id")
    per_order = details.groupBy("order_id").agg(F.sum("line_total").alias("order_total"))
    return (
        recent.join(per_order, "order_id")
        .join(customer.select("customer_id", F.col("full_name").alias("customer_name")), "customer_id")
        .groupBy("customer_name", "order_date", "order_status")
        .agg(F.sum("order_total").cast("decimal(38,2)").alias("order_total"))
        .select(
            quarter_label(F.date_trunc("quarter", "order_date")).alias("quarter_label"),
            "customer_name",
            F.col("order_date").cast("date").alias("order_date"),
            "order_status",
            "order_total",
        )
    )
