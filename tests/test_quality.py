import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

from helpers import rows_of
from salesloom.operators.quality import (
    ForeignKey,
    NotNull,
    Unique,
    conform,
    grants_by_name,
    integrity_report,
    null_audit,
    rows_by_principal,
    schema_drift,
    visible_rows,
)
from salesloom.sources import declared

D = dt.date


def nullable(schema):
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def report(spark, schemas, rows):
    tables = {name: spark.createDataFrame(rows.get(name, []), nullable(schema)) for name, schema in schemas.items()}
    out = integrity_report(tables, declared.rules_for(schemas), declared.KEYS)
    return {(r.table_name, r.rule): (r.violations, r.first_key, r.last_key) for r in out.collect()}


METRO = {
    "lines": [(1, "Red", "red"), (2, "", "blue")],
    "stations": [(1, "A", None, True, D(2001, 1, 1)), (2, "A", None, None, D(1999, 1, 1))],
    "trains": [(1, None, 10, None, "Active"), (2, "T", -1, D(1990, 1, 1), "Lost")],
    "roles": [(1, "Driver")],
    "employees": [(1, "Al", "L", D(2010, 1, 1), 1, None), (2, "Bo", "M", D(2010, 1, 1), 9, 77)],
    "ticket_types": [(1, "Day", Decimal("5.00"), 1)],
    "promotions": [(1, "P", Decimal("5.00"), D(2024, 2, 1), D(2024, 1, 1)), (2, "Q", Decimal("5.00"), D(2024, 2, 1), D(2024, 2, 1))],
    "schedules": [(1, "Peak", 1, "N", 0)],
    "line_stations": [(1, 1, 1), (1, 1, 2), (1, 3, 0)],
    "trips": [(1, D(2025, 1, 1), 1, 1, 1)],
    "stop_times": [(1, 1, 1, None, "08:00"), (2, 5, 1, "08:05", "08:06")],
    "maintenance_logs": [
        (1, D(2025, 1, 1), "x", 1, 1, None),
        (2, D(2025, 1, 1), "x", 1, 1, 1),
        (3, D(2025, 1, 1), "x", 1, None, None),
    ],
    "ticket_type_promotions": [(1, 1), (1, 2), (1, 9)],
}

BROKEN = {
    ("lines", "line_name not empty"): (1, "2", "2"),
    ("stations", "station_name unique"): (1, "A", "A"),
    ("stations", "has_disabled_access not null"): (1, "2", "2"),
    ("stations", "open_date from 2000"): (1, "2", "2"),
    ("trains", "capacity not negative"): (1, "2", "2"),
    ("trains", "purchase_date from 2000"): (1, "2", "2"),
    ("trains", "status allowed"): (1, "2", "2"),
    ("employees", "role_id in roles"): (1, "9", "9"),
    ("employees", "manager_id in employees"): (1, "77", "77"),
    ("promotions", "end_date not before start_date"): (1, "1", "1"),
    ("schedules", "frequency_mins positive"): (1, "1", "1"),
    ("line_stations", "line_id, station_id unique"): (1, "1|1", "1|1"),
    ("line_stations", "station_id in stations"): (1, "3", "3"),
    ("line_stations", "stop_sequence positive"): (1, "1|3", "1|3"),
    ("stop_times", "trip_id in trips"): (1, "5", "5"),
    ("maintenance_logs", "train or station, not both"): (2, "2", "3"),
    ("ticket_type_promotions", "promotion_id in promotions"): (1, "9", "9"),
}


def test_metro_rules_find_each_planted_violation(spark):
    found = report(spark, declared.metro_schemas(), METRO)
    assert {k: v for k, v in found.items() if v[0]} == BROKEN
    assert all(v == (0, None, None) for k, v in found.items() if k not in BROKEN)


def test_retail_rules(spark):
    rows = {
        "customer": [(1, "A", "B", "a@x", D(2024, 1, 1), None), (2, "A", "B", "a@x", D(2024, 1, 1), "n" * 151)],
        "employee": [(1, "  ", D(2024, 1, 1), None)],
        "supplier": [(1, "S", None), (2, "T", None)],
        "product": [(1, 1, 1, "P", Decimal("-1.00"))],
        "orders": [(1, 1, 1, D(2023, 12, 31), "Gone"), (2, 4, 1, D(2024, 1, 1), "Pending")],
        "order_detail": [(1, 1, 1, 0, Decimal("1.00"), None)],
    }
    found = report(spark, declared.retail_schemas(), rows)
    assert {k: v[0] for k, v in found.items() if v[0]} == {
        ("customer", "email unique"): 1,
        ("customer", "full_name at most 150 characters"): 1,
        ("employee", "emp_name not blank"): 1,
        ("product", "unit_price not negative"): 1,
        ("product", "category_id in category"): 1,
        ("orders", "order_date from 2024"): 1,
        ("orders", "order_status allowed"): 1,
        ("orders", "customer_id in customer"): 1,
        ("order_detail", "quantity positive"): 1,
    }


def test_twenty_tables_are_declared():
    assert len(declared.RETAIL_DDL) + len(declared.METRO_DDL) == 20 == len(declared.KEYS)


def test_null_audit_covers_every_table(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, record_ts date")
    assert rows_of(null_audit({"x": df, "y": df}, ["record_ts"])) == [("x", "record_ts", 2), ("y", "record_ts", 2)]
    assert rows_of(null_audit({"x": df})) == [("x", "a", 1), ("x", "record_ts", 2)]


def test_drift_is_reported_without_reading(spark):
    df = spark.createDataFrame([(1, "x")], "train_id bigint, colour string")
    wanted = T.StructType.fromDDL("train_id INT, status STRING")
    assert schema_drift(df, wanted) == [
        ("status", "missing"),
        ("colour", "not declared"),
        ("train_id", "bigint instead of int"),
    ]
    assert schema_drift(conform(df, wanted), wanted) == []


def test_conform_casts_defaults_and_lists_failures(spark):
    df = spark.createDataFrame([("1", "no"), ("x", None)], "id string, flag string")
    wanted = T.StructType.fromDDL("id INT, flag BOOLEAN, opened DATE")
    out = conform(df, wanted, {"flag": False, "opened": D(2024, 1, 1)}, failures="bad")
    assert rows_of(out) == [(1, False, D(2024, 1, 1), ""), (None, None, D(2024, 1, 1), "id")]


def test_principals_see_their_rows_only(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "customer_id int, v string")
    grants = spark.createDataFrame([("mia", 1), ("mia", 1), ("bob", 2), ("bob", None)], "principal string, customer_id int")
    assert rows_of(visible_rows(rows, grants, "mia", "customer_id")) == [(1, "a")]
    assert rows_of(visible_rows(rows, grants, "eve", "customer_id")) == []
    both = rows_by_principal(rows, grants, "customer_id").select("principal", "v")
    assert rows_of(both) == [("bob", "b"), ("mia", "a")]


def test_grant_goes_to_the_lowest_key_of_a_name(spark):
    people = spark.createDataFrame([(4, "MIA", "STONE"), (2, "MIA", "STONE")], "customer_id int, first string, last string")
    principals = spark.createDataFrame([("m", "MIA", "STONE"), ("x", "NO", "ONE")], "principal string, first string, last string")
    assert rows_of(grants_by_name(principals, people, ["first", "last"], "customer_id")) == [("m", 2)]


def test_sample_keys_are_ordered_by_their_type(spark):
    rows = spark.createDataFrame([(9, None), (10, None), (100, None), (100, None), (None, None)], "k int, v string")
    rules = [NotNull("t", "v"), Unique("t", ("k",))]
    out = integrity_report({"t": rows}, rules, {"t": ["k"]}).collect()
    assert [(r.violations, r.first_key, r.last_key) for r in out] == [(5, "NULL", "100"), (1, "100", "100")]


def test_keys_of_all_rules_are_counted_together(spark):
    """Keys of several types, one key under three rules, NULL parts, and parents of another integer type."""
    child = spark.createDataFrame(
        [(1, "a", 7), (1, "a", 7), (2, "b", None), (3, None, 9), (3, None, 9), (9, "z", 8)], "k int, s string, n bigint"
    )
    one = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id bigint")
    two = spark.createDataFrame([(1,), (3,)], "id smallint")
    named = spark.createDataFrame([("a", 1), ("b", 2)], "s string, k int")
    rules = [
        Unique("t", ("k",)),
        ForeignKey("t", ("k",), "one", ("id",)),
        ForeignKey("t", ("k",), "two", ("id",)),
        Unique("t", ("k", "s")),
        ForeignKey("t", ("s", "k"), "named", ("s", "k")),
        Unique("t", ("n",)),
    ]
    tables = {"t": child, "one": one, "two": two, "named": named}
    out = integrity_report(tables, rules, {"t": ["k"]}).collect()
    assert [(r.violations, r.first_key, r.last_key) for r in out] == [
        (2, "1", "3"),
        (3, "3", "9"),
        (2, "2", "9"),
        (1, "1|a", "1|a"),
        (1, "z|9", "z|9"),
        (2, "7", "9"),
    ]
    none = {name: df.limit(0) for name, df in tables.items()}
    assert {r.violations for r in integrity_report(none, rules, {"t": ["k"]}).collect()} == {0}
