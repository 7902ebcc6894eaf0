"""Declared tables of the order book and of the transit network, and the rules their rows must keep."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.functions.derived import employee_code, full_name, line_total
from salesloom.operators.quality import Check, ForeignKey, NotNull, Rule, Unique, conform


# Table and column names, types, nullability, keys and value rules.
RETAIL_DDL = {
    "customer": "customer_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
    "email STRING NOT NULL, created_on DATE NOT NULL, full_name STRING",
    "employee": "employee_id INT NOT NULL, emp_name STRING NOT NULL, hire_date DATE NOT NULL, employee_code STRING",
    "category": "category_id INT NOT NULL, category_name STRING NOT NULL",
    "supplier": "supplier_id INT NOT NULL, supplier_name STRING NOT NULL, contact_email STRING",
    "product": "product_id INT NOT NULL, category_id INT NOT NULL, supplier_id INT NOT NULL, "
    "product_name STRING NOT NULL, unit_price DECIMAL(10,2) NOT NULL",
    "orders": "order_id INT NOT NULL, customer_id INT NOT NULL, employee_id INT NOT NULL, "
    "order_date DATE NOT NULL, order_status STRING NOT NULL",
    "order_detail": "order_detail_id INT NOT NULL, order_id INT NOT NULL, product_id INT NOT NULL, "
    "quantity INT NOT NULL, unit_price DECIMAL(10,2) NOT NULL, line_total DECIMAL(12,2)",
}

# Arrival and departure are kept as HH:mm text.
METRO_DDL = {
    "lines": "line_id INT NOT NULL, line_name STRING NOT NULL, line_color STRING NOT NULL",
    "stations": "station_id INT NOT NULL, station_name STRING NOT NULL, location_desc STRING, "
    "has_disabled_access BOOLEAN NOT NULL, open_date DATE NOT NULL",
    "trains": "train_id INT NOT NULL, model_name STRING, capacity INT NOT NULL, purchase_date DATE, "
    "status STRING NOT NULL",
    "roles": "role_id INT NOT NULL, role_name STRING NOT NULL",
    "employees": "employee_id INT NOT NULL, first_name STRING NOT NULL, last_name STRING NOT NULL, "
    "hire_date DATE NOT NULL, role_id INT NOT NULL, manager_id INT",
    "ticket_types": "ticket_type_id INT NOT NULL, type_name STRING NOT NULL, base_price DECIMAL(10,2) NOT NULL, "
    "validity_days INT",
    "promotions": "promotion_id INT NOT NULL, promotion_name STRING NOT NULL, "
    "discount_percent DECIMAL(5,2) NOT NULL, start_date DATE NOT NULL, end_date DATE NOT NULL",
    "schedules": "schedule_id INT NOT NULL, schedule_name STRING NOT NULL, line_id INT NOT NULL, "
    "direction STRING NOT NULL, frequency_mins INT NOT NULL",
    "line_stations": "line_id INT NOT NULL, station_id INT NOT NULL, stop_sequence INT NOT NULL",
    "trips": "trip_id INT NOT NULL, trip_date DATE NOT NULL, schedule_id INT NOT NULL, train_id INT NOT NULL, "
    "driver_id INT NOT NULL",
    "stop_times": "stop_time_id INT NOT NULL, trip_id INT NOT NULL, station_id INT NOT NULL, "
    "arrival_time STRING, departure_time STRING",
    "maintenance_logs": "log_id INT NOT NULL, maintenance_date DATE NOT NULL, description STRING NOT NULL, "
    "technician_id INT NOT NULL, train_id INT, station_id INT",
    "ticket_type_promotions": "ticket_type_id INT NOT NULL, promotion_id INT NOT NULL",
}

# Keys.
KEYS = {
    "customer": ("customer_id",),
    "employee": ("employee_id",),
    "category": ("category_id",),
    "supplier": ("supplier_id",),
    "product": ("product_id",),
    "orders": ("order_id",),
    "order_detail": ("order_detail_id",),
    "lines": ("line_id",),
    "stations": ("station_id",),
    "trains": ("train_id",),
    "roles": ("role_id",),
    "employees": ("employee_id",),
    "ticket_types": ("ticket_type_id",),
    "promotions": ("promotion_id",),
    "schedules": ("schedule_id",),
    "line_stations": ("line_id", "station_id"),
    "trips": ("trip_id",),
    "stop_times": ("stop_time_id",),
    "maintenance_logs": ("log_id",),
    "ticket_type_promotions": ("ticket_type_id", "promotion_id"),
}

# Unique text columns.
UNIQUE_TEXT = {
    "customer": ("email",),
    "category": ("category_name",),
    "supplier": ("supplier_name", "contact_email"),
    "lines": ("line_name",),
    "stations": ("station_name",),
    "roles": ("role_name",),
    "ticket_types": ("type_name",),
    "promotions": ("promotion_name",),
}

# Text lengths.
LENGTHS = {
    "customer": {"first_name": 60, "last_name": 60, "email": 120, "full_name": 150},
    "employee": {"emp_name": 120, "employee_code": 200},
    "category": {"category_name": 100},
    "supplier": {"supplier_name": 120, "contact_email": 120},
    "product": {"product_name": 120},
    "orders": {"order_status": 20},
    "lines": {"line_name": 100, "line_color": 50},
    "stations": {"station_name": 100, "location_desc": 255},
    "trains": {"model_name": 100, "status": 50},
    "roles": {"role_name": 100},
    "employees": {"first_name": 100, "last_name": 100},
    "ticket_types": {"type_name": 100},
    "promotions": {"promotion_name": 100},
    "schedules": {"schedule_name": 100, "direction": 50},
}

# References to other tables.
REFERENCES = {
    "product": {"category_id": ("category", "category_id"), "supplier_id": ("supplier", "supplier_id")},
    "orders": {"customer_id": ("customer", "customer_id"), "employee_id": ("employee", "employee_id")},
    "order_detail": {"order_id": ("orders", "order_id"), "product_id": ("product", "product_id")},
    "employees": {"role_id": ("roles", "role_id"), "manager_id": ("employees", "employee_id")},
    "schedules": {"line_id": ("lines", "line_id")},
    "line_stations": {"line_id": ("lines", "line_id"), "station_id": ("stations", "station_id")},
    "trips": {
        "schedule_id": ("schedules", "schedule_id"),
        "train_id": ("trains", "train_id"),
        "driver_id": ("employees", "employee_id"),
    },
    "stop_times": {"trip_id": ("trips", "trip_id"), "station_id": ("stations", "station_id")},
    "maintenance_logs": {
        "technician_id": ("employees", "employee_id"),
        "train_id": ("trains", "train_id"),
        "station_id": ("stations", "station_id"),
    },
    "ticket_type_promotions": {
        "ticket_type_id": ("ticket_types", "ticket_type_id"),
        "promotion_id": ("promotions", "promotion_id"),
    },
}

CHECKS = {
    "employee": {"emp_name not blank": "trim(emp_name) <> ''"},
    "product": {"unit_price not negative": "unit_price >= 0"},
    "orders": {
        "order_date from 2024": "order_date >= DATE '2024-01-01'",
        "order_status allowed": "order_status IN ('Pending', 'Shipped', 'Completed', 'Cancelled')",
    },
    "order_detail": {"quantity positive": "quantity > 0"},
    "lines": {"line_name not empty": "line_name <> ''"},
    "stations": {"open_date from 2000": "open_date >= DATE '2000-01-01'"},
    "trains": {
        "capacity not negative": "capacity >= 0",
        "purchase_date from 2000": "purchase_date >= DATE '2000-01-01'",
        "status allowed": "status IN ('Active', 'In Repair', 'Retired')",
    },
    "employees": {"hire_date from 2000": "hire_date >= DATE '2000-01-01'"},
    "ticket_types": {"base_price not negative": "base_price >= 0"},
    "promotions": {
        "start_date from 2000": "start_date >= DATE '2000-01-01'",
        "end_date not before start_date": "end_date >= start_date",
    },
    "schedules": {"frequency_mins positive": "frequency_mins > 0"},
    "line_stations": {"stop_sequence positive": "stop_sequence > 0"},
    "trips": {"trip_date from 2000": "trip_date >= DATE '2000-01-01'"},
    "maintenance_logs": {
        "maintenance_date from 2000": "maintenance_date >= DATE '2000-01-01'",
        "train or station, not both": "(train_id IS NULL) <> (station_id IS NULL)",
    },
}

# Columns filled at load when they are missing; dates take the load date.
DEFAULTS = {
    "product": {"unit_price": 0},
    "orders": {"order_status": "Pending"},
    "stations": {"has_disabled_access": False},
}
LOAD_DATE_DEFAULTS = {
    "customer": "created_on",
    "employee": "hire_date",
    "orders": "order_date",
    "employees": "hire_date",
}
GENERATED = {
    "customer": ("full_name", full_name),
    "employee": ("employee_code", employee_code),
    "order_detail": ("line_total", line_total),
}


def declared_schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def retail_schemas() -> dict[str, T.StructType]:
    return {table: declared_schema(ddl) for table, ddl in RETAIL_DDL.items()}


def metro_schemas() -> dict[str, T.StructType]:
    return {table: declared_schema(ddl) for table, ddl in METRO_DDL.items()}


class Declared(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


def as_declared(df: DataFrame, table: str, schema: T.StructType, load_date: dt.date) -> Declared:
    """Rows in the declared shape of a table: types, column order, defaults and computed columns.

    A default stands only for a column that ``df`` lacks. Rows with a value that does not fit, or a NULL where the
    table has none, are rejects; ``bad_columns`` lists those columns.
    """
    defaults = dict(DEFAULTS.get(table, {}))
    if table in LOAD_DATE_DEFAULTS:
        defaults[LOAD_DATE_DEFAULTS[table]] = load_date
    shaped = conform(df, schema, defaults, failures="_lost")
    if table in GENERATED:
        name, expression = GENERATED[table]
        shaped = shaped.withColumn(name, expression())
    lost = F.split("_lost", ",")
    bad = [
        F.when(F.array_contains(lost, f.name) | (F.col(f.name).isNull() if not f.nullable else F.lit(False)), F.lit(f.name))
        for f in schema
    ]
    checked = shaped.withColumn("bad_columns", F.concat_ws(",", *bad)).drop("_lost")
    fine = F.col("bad_columns") == ""
    return Declared(checked.filter(fine).drop("bad_columns"), checked.filter(~fine))


def rules_for(schemas: dict[str, T.StructType]) -> list[Rule]:
    """All rules of the given tables: nullability, keys, references, lengths and value checks."""
    rules: list[Rule] = []
    for table, schema in schemas.items():
        rules += [NotNull(table, field.name) for field in schema if not field.nullable]
        rules.append(Unique(table, KEYS[table]))
        rules += [Unique(table, (column,)) for column in UNIQUE_TEXT.get(table, ())]
        rules += [
            Check(table, f"{column} at most {n} characters", f"length({column}) <= {n}")
            for column, n in LENGTHS.get(table, {}).items()
        ]
        rules += [Check(table, name, condition) for name, condition in CHECKS.get(table, {}).items()]
        rules += [
            ForeignKey(table, (column,), parent, (key,))
            for column, (parent, key) in REFERENCES.get(table, {}).items()
        ]
    return rules
