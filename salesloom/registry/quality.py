"""Integrity, nulls, declared types, row visibility."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators.quality import (
    Check,
    ForeignKey,
    NotNull,
    Unique,
    conform,
    grants_by_name,
    integrity_report,
    null_audit,
    rows_by_principal,
    visible_rows,
)
from salesloom.registry import query
from salesloom.sources.tables import SCHEMAS, Tables


def _columns(table: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[table].split(", ")]


@query(
    "null_audit",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM {table}"
        for table in SCHEMAS
        for c in _columns(table)
    ),
)
def null_audit_all(t: Tables) -> DataFrame:
    return null_audit({name: getattr(t, name) for name in SCHEMAS})


_RULES = [
    NotNull("orders", "o_custkey"),
    Check("orders", "status allowed", "o_orderstatus IN ('O', 'F')"),
    Check("orders", "date from 1996", "o_orderdate >= TIMESTAMP_NTZ '1996-01-01 00:00:00'"),
    Check("orders", "total not negative", "o_totalprice >= 0"),
    Unique("orders", ("o_orderkey",)),
    ForeignKey("orders", ("o_custkey",), "customer", ("c_custkey",)),
    NotNull("line", "closed_on"),
    Check("line", "closed after start of 1996", "closed_on >= TIMESTAMP_NTZ '1996-01-01 00:00:00'"),
    Check("line", "tax not below discount", "l_tax >= l_discount"),
    Check("line", "closed or returned, not both", "(closed_on IS NULL) <> (returned IS NULL)"),
    Unique("line", ("l_orderkey", "l_linenumber")),
    Unique("line", ("returned",)),
    ForeignKey("line", ("l_orderkey",), "orders", ("o_orderkey",)),
    ForeignKey("line", ("returned",), "part", ("p_partkey",)),
]

_LINE = """
line AS (SELECT l_orderkey, l_linenumber, l_tax, l_discount,
                CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS closed_on,
                CASE WHEN l_returnflag = 'R' THEN l_partkey END AS returned,
                {'k': l_orderkey, 'n': l_linenumber} AS key FROM lineitem)
"""


def _counted(table: str, rule: str, source: str, where: str, key: str, count: str = "COUNT(*)") -> str:
    low, high = f"MIN({key})", f"MAX({key})"
    if key == "key":
        low, high = (f"({k}).k || '|' || ({k}).n" for k in (low, high))
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST({count} AS BIGINT) AS violations, "
        f"CAST({low} AS VARCHAR) AS first_key, CAST({high} AS VARCHAR) AS last_key FROM {source} WHERE {where}"
    )


_INTEGRITY_ORACLE = f"WITH {_LINE} " + " UNION ALL ".join(
    [
        _counted("orders", "o_custkey not null", "orders", "o_custkey IS NULL", "o_orderkey"),
        _counted("orders", "status allowed", "orders", "NOT o_orderstatus IN ('O', 'F')", "o_orderkey"),
        _counted("orders", "date from 1996", "orders", "NOT o_orderdate >= TIMESTAMP '1996-01-01'", "o_orderkey"),
        _counted("orders", "total not negative", "orders", "NOT o_totalprice >= 0", "o_orderkey"),
        _counted(
            "orders",
            "o_orderkey unique",
            "(SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)",
            "TRUE",
            "o_orderkey",
        ),
        _counted(
            "orders",
            "o_custkey in customer",
            "orders",
            "o_custkey NOT IN (SELECT c_custkey FROM customer)",
            "o_custkey",
        ),
        _counted("line", "closed_on not null", "line", "closed_on IS NULL", "key"),
        _counted("line", "closed after start of 1996", "line", "NOT closed_on >= TIMESTAMP '1996-01-01'", "key"),
        _counted("line", "tax not below discount", "line", "NOT l_tax >= l_discount", "key"),
        _counted(
            "line", "closed or returned, not both", "line", "NOT ((closed_on IS NULL) <> (returned IS NULL))", "key"
        ),
        _counted(
            "line",
            "l_orderkey, l_linenumber unique",
            "(SELECT key FROM line GROUP BY 1 HAVING COUNT(*) > 1)",
            "TRUE",
            "key",
        ),
        _counted(
            "line",
            "returned unique",
            "(SELECT returned FROM line WHERE returned IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)",
            "TRUE",
            "returned",
        ),
        _counted("line", "l_orderkey in orders", "line", "l_orderkey NOT IN (SELECT o_orderkey FROM orders)", "l_orderkey"),
        _counted(
            "line",
            "returned in part",
            "line",
            "returned IS NOT NULL AND returned NOT IN (SELECT p_partkey FROM part)",
            "returned",
        ),
    ]
)


@query("integrity_report", _INTEGRITY_ORACLE)
def integrity_report_all(t: Tables) -> DataFrame:
    line = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_tax",
        "l_discount",
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("closed_on"),
        F.when(F.col("l_returnflag") == "R", F.col("l_partkey")).alias("returned"),
    )
    tables = {
        "orders": t.orders,
        "line": line,
        "customer": t.customer,
        "part": t.part,
    }
    return integrity_report(tables, _RULES, {"orders": ["o_orderkey"], "line": ["l_orderkey", "l_linenumber"]})


@query(
    "conform_schema",
    """
SELECT CAST(o_orderkey AS INTEGER) AS order_id,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(10,2)) END AS total,
       CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS DATE) END AS order_date,
       'Pending' AS order_status,
       CONCAT_WS(',', CASE WHEN o_orderstatus = 'P' THEN 'total' END,
                      CASE WHEN o_orderpriority = '5-LOW' THEN 'order_date' END) AS bad_values
FROM orders
""",
)
def conform_schema(t: Tables) -> DataFrame:
    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
        .alias("total"),
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("order_date"),
    )
    declared = T.StructType.fromDDL("order_id INT, total DECIMAL(10,2), order_date DATE, order_status STRING")
    return conform(raw, declared, {"order_date": "2001-12-31", "order_status": "Pending"}, failures="bad_values")


def _entitlements(t: Tables) -> DataFrame:
    """One principal per nation, granted its own customers."""
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("desk_"), F.lower("n_name")).alias("principal"), F.col("c_custkey").alias("o_custkey")
    )


@query(
    "row_filter_by_principal",
    """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey
                    WHERE 'desk_' || LOWER(n_name) = 'desk_nation_3')
""",
)
def row_filter_by_principal(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return visible_rows(orders, _entitlements(t), "desk_nation_3", "o_custkey")


@query(
    "visible_rows_per_principal",
    """
SELECT 'desk_' || LOWER(n_name) AS principal, COUNT(*) AS visible
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""",
)
def visible_rows_per_principal(t: Tables) -> DataFrame:
    orders = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    views = rows_by_principal(orders, _entitlements(t), "o_custkey")
    return views.groupBy("principal").agg(F.sum("n").alias("visible"))


@query(
    "grants_by_name",
    """
SELECT 'buyer of ' || p_name || ' ' || p_type AS principal, MIN(p_partkey) AS l_partkey FROM part
GROUP BY p_name, p_type
""",
)
def grants_by_part_name(t: Tables) -> DataFrame:
    people = t.part.select("p_name", "p_type", F.col("p_partkey").alias("l_partkey"))
    known = people.select("p_name", "p_type").distinct()
    nobody = known.select(F.lit("nobody").alias("p_name"), "p_type").distinct()
    principal = F.concat_ws(" ", F.lit("buyer of"), "p_name", "p_type").alias("principal")
    principals = known.unionByName(nobody).select("p_name", "p_type", principal)
    return grants_by_name(principals, people, ["p_name", "p_type"], "l_partkey")
