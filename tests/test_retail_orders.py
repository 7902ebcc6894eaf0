import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.functions import derived
from salesloom.plans import retail_orders as book
from salesloom.sources.declared import as_declared, retail_schemas

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    schemas = retail_schemas()
    rows = {
        "customer": [(1, "Ann", "Li", "ann@x", D(2024, 1, 1), None), (2, "Bo", "Re", "bo@x", D(2024, 1, 1), None)],
        "employee": [(5, "Jane Ford", D(2024, 1, 1), None)],
        "product": [(7, 1, 1, "Lamp", Decimal("10.50")), (8, 1, 1, "Desk", Decimal("99.99"))],
        "orders": [
            (1, 1, 5, D(2025, 3, 31), "Completed"),
            (2, 1, 5, D(2025, 4, 2), "Pending"),
            (3, 1, 5, D(2025, 4, 2), "Pending"),
            (4, 2, 5, D(2025, 6, 30), "Shipped"),
        ],
        "order_detail": [
            (1, 1, 7, 1, Decimal("10.50"), Decimal("10.50")),
            (2, 2, 7, 2, Decimal("10.50"), Decimal("21.00")),
            (3, 3, 8, 1, Decimal("99.99"), Decimal("99.99")),
            (9, 4, 8, 1, Decimal("90.00"), Decimal("90.00")),
        ],
    }
    built = {name: spark.createDataFrame(data, schemas[name]) for name, data in rows.items()}
    built["customer"] = built["customer"].withColumn("full_name", derived.full_name())
    return built


def test_derived_columns(tables):
    assert rows_of(tables["customer"].select("full_name")) == [("Ann Li",), ("Bo Re",)]
    assert tables["employee"].select(derived.employee_code()).first()[0] == "JANE FORD"
    assert rows_of(tables["order_detail"].filter(derived.line_total() != F.col("line_total"))) == []


def test_latest_quarter_merges_same_day_orders(tables):
    out = book.recent_quarter_report(tables["orders"], tables["order_detail"], tables["customer"])
    assert rows_of(out) == [
        ("2025-Q2", "Ann Li", D(2025, 4, 2), "Pending", Decimal("120.99")),
        ("2025-Q2", "Bo Re", D(2025, 6, 30), "Shipped", Decimal("90.00")),
    ]


def test_latest_quarter_of_an_empty_book(tables):
    empty = tables["orders"].limit(0)
    assert book.recent_quarter_report(empty, tables["order_detail"], tables["customer"]).collect() == []


def add(spark, tables, *rows):
    batch = spark.createDataFrame(
        list(rows),
        "batch_id int, customer_email string, employee_name string, product_name string, quantity int, "
        "order_date date, order_status string, unit_price decimal(10,2)",
    )
    return book.add_transactions(
        tables["orders"],
        tables["order_detail"],
        tables["customer"],
        tables["employee"],
        tables["product"],
        batch,
        as_of=D(2025, 7, 1),
    )


def test_transactions_get_keys_defaults_and_prices(spark, tables):
    added = add(
        spark,
        tables,
        (1, "ann@x", "Jane Ford", "Lamp", 3, None, None, None),
        (2, "bo@x", "Jane Ford", "Desk", 1, D(2025, 1, 1), "Completed", Decimal("80.00")),
    )
    assert rows_of(added.orders) == [(5, 1, 5, D(2025, 7, 1), "Pending"), (6, 2, 5, D(2025, 1, 1), "Completed")]
    assert rows_of(added.details) == [
        (10, 5, 7, 3, Decimal("10.50"), Decimal("31.50")),
        (11, 6, 8, 1, Decimal("80.00"), Decimal("80.00")),
    ]
    assert added.rejects.collect() == []


@pytest.mark.parametrize(
    ("row", "reason"),
    [
        ((1, "no@x", "Jane Ford", "Lamp", 1, None, None, None), "customer_email not found"),
        ((1, "ann@x", "nobody", "Lamp", 1, None, None, None), "employee_name not found"),
        ((1, "ann@x", "Jane Ford", "lamp", 1, None, None, None), "product_name not found"),
        ((1, "ann@x", "Jane Ford", "Lamp", 0, None, None, None), "quantity must be positive"),
        ((1, "ann@x", "Jane Ford", "Lamp", None, None, None, None), "quantity must be positive"),
        ((1, "ann@x", "Jane Ford", "Lamp", 1, D(2023, 12, 31), None, None), "order_date too early"),
        ((1, "ann@x", "Jane Ford", "Lamp", 1, None, "Lost", None), "order_status not allowed"),
    ],
)
def test_bad_transactions_are_rejected(spark, tables, row, reason):
    added = add(spark, tables, row)
    assert [r.reject_reason for r in added.rejects.collect()] == [reason]
    assert added.orders.collect() == [] and added.details.collect() == []


def test_change_one_field_of_one_order(spark, tables):
    change = spark.createDataFrame(
        [(2, "order_status", "Shipped", 1)], "order_id int, column_name string, new_value string, sequence int"
    )
    before = tables["orders"]
    after, rejects = book.change_order_fields(before, change, tables["customer"], tables["employee"])
    assert rejects.collect() == []
    assert after.schema.names == before.schema.names
    assert set(rows_of(after)) - set(rows_of(before)) == {(2, 1, 5, D(2025, 4, 2), "Shipped")}


def test_changes_that_break_a_rule_are_rejected(spark, tables):
    change = spark.createDataFrame(
        [
            (2, "order_status", "Bogus", 1),
            (2, "order_date", "1990-01-01", 2),
            (2, "order_date", "soon", 3),
            (2, "customer_id", "999", 4),
            (2, "note", "x", 5),
            (2, "order_status", None, 6),
            (77, "order_status", "Shipped", 7),
            (2, "order_status", "Shipped", 8),
        ],
        "order_id int, column_name string, new_value string, sequence int",
    )
    after, rejects = book.change_order_fields(tables["orders"], change, tables["customer"], tables["employee"])
    assert [r.reject_reason for r in rejects.orderBy("sequence").collect()] == [
        "order_status not allowed",
        "order_date too early",
        "value does not fit the type",
        "customer_id not found",
        "column cannot be changed",
        "value must not be NULL",
        "order_id not found",
    ]
    assert set(rows_of(after)) - set(rows_of(tables["orders"])) == {(2, 1, 5, D(2025, 4, 2), "Shipped")}


def test_a_line_total_beyond_its_type_is_a_reject(spark, tables):
    added = add(spark, tables, (1, "ann@x", "Jane Ford", "Lamp", 2_000_000_000, None, None, Decimal("99999999.99")))
    assert [r.reject_reason for r in added.rejects.collect()] == ["line_total does not fit"]
    assert added.orders.collect() == []


def test_orders_of_one_customer_newest_first(tables):
    out = book.orders_of_customer(tables["orders"], tables["customer"], tables["employee"], "ann@x")
    assert [(r.order_id, r.handled_by) for r in out.collect()] == [(2, "Jane Ford"), (3, "Jane Ford"), (1, "Jane Ford")]


def test_rows_take_the_declared_shape(spark):
    raw = spark.createDataFrame([("1", "Ann", "Li", "ann@x")], "customer_id string, first_name string, last_name string, email string")
    schema = retail_schemas()["customer"]
    shaped, rejects = as_declared(raw, "customer", schema, D(2024, 5, 1))
    assert rejects.collect() == []
    bad = spark.createDataFrame(
        [("1", "Ann", "Li", "ann@x", "soon"), ("x", None, "Li", "bo@x", "2024-01-02")],
        "customer_id string, first_name string, last_name string, email string, created_on string",
    )
    fine, rejects = as_declared(bad, "customer", schema, D(2024, 5, 1))
    assert fine.collect() == []
    assert sorted(r.bad_columns for r in rejects.collect()) == ["created_on", "customer_id,first_name"]
    assert [(f.name, f.dataType) for f in shaped.schema] == [(f.name, f.dataType) for f in schema]
    assert rows_of(shaped) == [(1, "Ann", "Li", "ann@x", D(2024, 5, 1), "Ann Li")]
