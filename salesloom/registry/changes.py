"""Data-change jobs over the test tables."""

from __future__ import annotations

import datetime as dt
import functools
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.derived import employee_code, full_name, line_total
from salesloom.functions.money import cents, from_cents
from salesloom.operators import changes
from salesloom.operators.lookup import (
    in_set,
    lowest_dimension_key,
    map_by_rules,
    not_in_set,
    resolve_keys,
    with_counts,
)
from salesloom.plans import film_rental
from salesloom.registry import query
from salesloom.sources import roles, storage
from salesloom.sources.inline import literal_rows
from salesloom.sources.tables import Tables

_NAME_BATCH = """
batch AS (SELECT s_name AS name, 'supplier' AS origin, 1 AS seq FROM supplier
          UNION ALL SELECT UPPER(s_name), 'supplier again', 2 FROM supplier
          UNION ALL SELECT UPPER(c_name), 'customer again', 3 FROM customer
          UNION ALL SELECT c_name, 'customer again', 4 FROM customer),
existing AS (SELECT c_name AS name, 'customer' AS origin, 0 AS seq FROM customer)
"""


def _names(t: Tables) -> tuple[DataFrame, DataFrame]:
    def part(df: DataFrame, name, origin: str, seq: int) -> DataFrame:
        return df.select(name.alias("name"), F.lit(origin).alias("origin"), F.lit(seq).alias("seq"))

    existing = part(t.customer, F.col("c_name"), "customer", 0)
    batch = [
        part(t.supplier, F.col("s_name"), "supplier", 1),
        part(t.supplier, F.upper("s_name"), "supplier again", 2),
        part(t.customer, F.upper("c_name"), "customer again", 3),
        part(t.customer, F.col("c_name"), "customer again", 4),
    ]
    return existing, functools.reduce(DataFrame.unionByName, batch)


@query(
    "idempotent_append",
    f"""
WITH {_NAME_BATCH}
SELECT * FROM existing
UNION ALL
SELECT name, origin, seq FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY LOWER(TRIM(name)) ORDER BY seq) AS rn FROM batch
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE LOWER(TRIM(e.name)) = LOWER(TRIM(batch.name))))
WHERE rn = 1
""",
)
def idempotent_append(t: Tables) -> DataFrame:
    existing, batch = _names(t)
    return changes.append_missing(existing, batch, ["name"], [F.col("seq")])


@query(
    "append_skip_conflict",
    f"""
WITH {_NAME_BATCH}
SELECT * FROM existing
UNION ALL
SELECT name, origin, seq FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY name ORDER BY seq) AS rn FROM batch
  WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.name = batch.name))
WHERE rn = 1
""",
)
def append_skip_conflict(t: Tables) -> DataFrame:
    existing, batch = _names(t)
    return changes.append_skip_conflict(existing, batch, ["name"], [F.col("seq")])


@query(
    "resolve_keys",
    """
WITH batch AS (
  SELECT o_orderkey, CASE WHEN o_totalprice > 450000 THEN 'nobody'
                          ELSE 'Customer#' || LPAD(CAST(o_custkey AS VARCHAR), 9, '0') END AS customer_name,
         'NATION_' || (o_custkey % 30) AS nation_name
  FROM orders)
SELECT o_orderkey, c.k AS customer_id, n_nationkey AS nation_id,
       CASE WHEN c.k IS NULL THEN 'customer_name not found' WHEN n_nationkey IS NULL THEN 'nation_name not found' END
         AS reject_reason
FROM batch LEFT JOIN (SELECT c_name, MIN(c_custkey) AS k FROM customer GROUP BY c_name) c ON customer_name = c_name
     LEFT JOIN nation ON nation_name = n_name
""",
)
def resolve_order_keys(t: Tables) -> DataFrame:
    name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    batch = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_totalprice") > 450000, "nobody").otherwise(name).alias("customer_name"),
        F.concat(F.lit("NATION_"), F.pmod("o_custkey", F.lit(30)).cast("string")).alias("nation_name"),
    )
    resolved = resolve_keys(
        batch,
        {
            "customer_name": (t.customer, "c_name", "c_custkey", "customer_id"),
            "nation_name": (t.nation, "n_name", "n_nationkey", "nation_id"),
        },
    )
    return resolved.select("o_orderkey", "customer_id", "nation_id", "reject_reason")


@query(
    "lowest_key_lookup",
    "SELECT LOWER(TRIM(p_name)) AS p_name, MIN(p_partkey) AS p_partkey FROM part GROUP BY 1",
)
def lowest_key_lookup(t: Tables) -> DataFrame:
    return lowest_dimension_key(t.part, "p_name", "p_partkey")


@query(
    "add_items",
    """
WITH batch AS (
  SELECT s_name AS title, CASE WHEN s_acctbal > 5000 THEN 1999 END AS release_year, LOWER(n_name) AS language_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT UPPER(p_name || ' ' || p_brand), 1990, 'nation_1' FROM part
  UNION ALL SELECT c_name, 1991, 'unknown' FROM customer),
fresh AS (
  SELECT title, release_year, n_nationkey AS language_id FROM batch JOIN nation ON LOWER(n_name) = language_name
  WHERE NOT EXISTS (SELECT 1 FROM part WHERE LOWER(p_name || ' ' || p_brand) = LOWER(title)))
SELECT (SELECT MAX(p_partkey) FROM part) + ROW_NUMBER() OVER (ORDER BY title) AS film_id, title,
       COALESCE(release_year, 2001) AS release_year, language_id, 3 AS rental_duration,
       CAST(4.99 AS DECIMAL(4,2)) AS rental_rate, CAST(19.99 AS DECIMAL(5,2)) AS replacement_cost, 'G' AS rating,
       DATE '2001-12-31' AS last_update
FROM fresh
""",
)
def add_items(t: Tables) -> DataFrame:
    language = t.nation.select(F.col("n_nationkey").alias("language_id"), F.col("n_name").alias("name"))
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("title"),
        F.when(F.col("s_acctbal") > 5000, 1999).alias("release_year"),
        F.lower("n_name").alias("language_name"),
    )
    known = roles.film(t).select(
        F.upper("title").alias("title"), F.lit(1990).alias("release_year"), F.lit("nation_1").alias("language_name")
    )
    foreign = t.customer.select(
        F.col("c_name").alias("title"), F.lit(1991).alias("release_year"), F.lit("unknown").alias("language_name")
    )
    batch = suppliers.unionByName(known).unionByName(foreign)
    rows, _ = film_rental.new_films(roles.film(t).select("film_id", "title"), language, batch, dt.date(2001, 12, 31))
    return rows


@query(
    "complete_grid",
    """
SELECT p_partkey, n_nationkey FROM part CROSS JOIN nation
WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
                  WHERE l_partkey = p_partkey AND s_nationkey = n_nationkey)
""",
)
def complete_grid(t: Tables) -> DataFrame:
    delivered = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").alias("p_partkey"), F.col("s_nationkey").alias("n_nationkey")
    )
    return changes.missing_pairs(t.part, t.nation, delivered, "p_partkey", "n_nationkey")


_RULES = [
    ("Brand#1", "SUPPLIER#000000003"),
    ("brand#2", "Supplier#000000004"),
    ("Brand#2", "Supplier#000000005"),
    ("BRAND#2", "supplier#000000004"),
    ("Brand#25", "Supplier#000000009"),
]


@query(
    "map_by_rules",
    """
SELECT p_partkey AS film_id, s_suppkey AS actor_id
FROM part JOIN supplier ON
  (LOWER(p_brand) = 'brand#1' AND LOWER(s_name) = 'supplier#000000003')
  OR (LOWER(p_brand) = 'brand#2' AND (LOWER(s_name) = 'supplier#000000004' OR LOWER(s_name) = 'supplier#000000005'))
  OR (LOWER(p_brand) = 'brand#25' AND LOWER(s_name) = 'supplier#000000009')
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey)
""",
)
def map_parts_by_rules(t: Tables) -> DataFrame:
    rules = literal_rows(t.spark, "brand string, supplier string", _RULES)
    actors = t.supplier.select(F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("actor_name"))
    pairs = map_by_rules(
        rules, roles.film(t).select("film_id", F.col("brand").alias("film_brand")), actors,
        {"brand": "film_brand"}, {"supplier": "actor_name"},
    )
    return not_in_set(pairs.select("film_id", "actor_id"), roles.film_supplier(t), ["film_id", "actor_id"])


@query(
    "keyed_update",
    """
WITH busy AS (SELECT o_custkey, MAX(o_totalprice) AS top FROM orders GROUP BY o_custkey HAVING COUNT(*) >= 12)
SELECT c_custkey, c_name, c_nationkey, CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE top END AS c_acctbal,
       CASE WHEN o_custkey IS NULL THEN c_mktsegment END AS c_mktsegment
FROM customer LEFT JOIN busy ON o_custkey = c_custkey
""",
)
def keyed_update(t: Tables) -> DataFrame:
    busy = (
        t.orders.groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("c_acctbal"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= 12)
        .withColumn("c_mktsegment", F.lit(None).cast("string"))
    )
    return changes.update_matched(t.customer, busy, ["c_custkey"], ["c_acctbal", "c_mktsegment"])


def _without_machinery(t: Tables) -> DataFrame:
    gone = t.customer.filter(F.lower("c_mktsegment") == "machinery").select(F.col("c_custkey").alias("o_custkey"))
    return changes.delete_keys(t.orders, gone, ["o_custkey"])


@query(
    "keyed_delete",
    """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
""",
)
def keyed_delete(t: Tables) -> DataFrame:
    return _without_machinery(t)


@query(
    "readback",
    """
SELECT c_custkey, c_name, c_mktsegment,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN 0
            ELSE (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) END AS orders_left
FROM customer
""",
)
def readback_after_delete(t: Tables) -> DataFrame:
    left = _without_machinery(t).select(F.col("o_custkey").alias("c_custkey"))
    customer = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return with_counts(customer, left, "c_custkey", "orders_left")


@query(
    "assign_keys",
    """
SELECT (SELECT COALESCE(MAX(c_custkey), 0) FROM customer) + ROW_NUMBER() OVER (ORDER BY s_name) AS customer_id, s_name
FROM supplier
""",
)
def assign_customer_keys(t: Tables) -> DataFrame:
    existing = t.customer.select(F.col("c_custkey").alias("customer_id"))
    return changes.assign_keys(existing, t.supplier.select("s_name"), "customer_id", [F.col("s_name")])


@query(
    "header_detail",
    """
WITH pairs AS (SELECT o_custkey, l_partkey, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
fresh AS (SELECT DISTINCT o_custkey, l_partkey FROM pairs WHERE l_returnflag <> 'R'
          EXCEPT SELECT o_custkey, l_partkey FROM pairs WHERE l_returnflag = 'R'),
headers AS (SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY o_custkey, l_partkey)
              AS rental_id, * FROM fresh)
SELECT rental_id, o_custkey AS customer_id, l_partkey AS film_id, CAST(p_retailprice AS DECIMAL(38,2)) AS amount,
       DATE '2017-01-01' AS payment_date
FROM headers JOIN part ON l_partkey = p_partkey
""",
)
def header_detail(t: Tables) -> DataFrame:
    pairs = roles.rentals(t).select("customer_id", "film_id", "kind")
    highest = changes.highest_key(t.orders, "o_orderkey")
    rented = pairs.filter(F.col("kind") == "R").select("customer_id", "film_id")
    wanted = pairs.filter(F.col("kind") != "R").select("customer_id", "film_id")
    key = ["customer_id", "film_id"]
    headers = changes.new_headers(rented, wanted, key, "rental_id", [F.col(c) for c in key], highest)
    prices = t.part.select(F.col("p_partkey").alias("film_id"), from_cents(cents("p_retailprice")).alias("amount"))
    return headers.join(prices, "film_id").select(
        "rental_id", *key, "amount", F.lit(dt.date(2017, 1, 1)).alias("payment_date")
    )


@query(
    "derived_columns",
    """
SELECT l_orderkey, l_linenumber, UPPER(p_name) AS product_code, p_name || ' ' || p_brand AS full_name,
       CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(10,2)) AS DECIMAL(12,2)) AS line_total
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def derived_columns(t: Tables) -> DataFrame:
    products = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        employee_code("p_name").alias("product_code"),
        full_name("p_name", "p_brand").alias("full_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
    )
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("quantity")
    )
    return lines.join(products, "l_partkey").select(
        "l_orderkey", "l_linenumber", "product_code", "full_name", line_total().alias("line_total")
    )


@query("audit_column", "SELECT *, DATE '2001-12-31' AS record_ts FROM supplier")
def audit_column(t: Tables) -> DataFrame:
    return changes.with_audit_column(t.supplier, F.lit(dt.date(2001, 12, 31)))


@query(
    "membership_filters",
    """
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)
  AND NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
""",
)
def membership_filters(t: Tables) -> DataFrame:
    key = F.col("o_custkey").alias("c_custkey")
    large = t.orders.filter(F.col("o_totalprice") > 450000).select(key)
    pending = t.orders.filter(F.col("o_orderstatus") == "P").select(key)
    return not_in_set(in_set(t.customer.select("c_custkey", "c_name"), large, "c_custkey"), pending, "c_custkey")


@query(
    "load_batch",
    """
WITH batch AS (SELECT c_name AS name, 'NATION_' || (c_custkey % 30) AS nation FROM customer
               UNION ALL SELECT UPPER(s_name), n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey),
fresh AS (SELECT name, n_nationkey FROM batch JOIN nation ON nation = n_name
          WHERE LOWER(TRIM(name)) NOT IN (SELECT LOWER(TRIM(s_name)) FROM supplier))
SELECT (SELECT MAX(s_suppkey) FROM supplier) + ROW_NUMBER() OVER (ORDER BY name) AS supplier_id, name,
       n_nationkey AS nation_id, CAST(NULL AS DOUBLE) AS balance
FROM fresh
""",
)
def load_supplier_batch(t: Tables) -> DataFrame:
    existing = t.supplier.select(
        F.col("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation_id"),
        F.col("s_acctbal").alias("balance"),
    )
    nation = F.concat(F.lit("NATION_"), F.pmod("c_custkey", F.lit(30)).cast("string"))
    again = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    batch = t.customer.select(F.col("c_name").alias("name"), nation.alias("nation")).unionByName(
        again.select(F.upper("s_name").alias("name"), F.col("n_name").alias("nation"))
    )
    lookups = {"nation": (t.nation, "n_name", "n_nationkey", "nation_id")}
    rows, _ = changes.load_batch(existing, batch, ["name"], "supplier_id", [F.col("name")], lookups)
    return rows


@query(
    "load_batch_rejects",
    """
WITH batch AS (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name, 'NATION_' || (c_custkey % 30) AS nation
               FROM customer)
SELECT name, nation,
       CASE WHEN nation NOT IN (SELECT n_name FROM nation) THEN 'nation not found' ELSE 'natural key is NULL' END
         AS reject_reason
FROM batch WHERE name IS NULL OR nation NOT IN (SELECT n_name FROM nation)
""",
)
def load_batch_rejects(t: Tables) -> DataFrame:
    existing = t.supplier.select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id")
    )
    batch = t.customer.select(
        F.when(F.pmod("c_custkey", F.lit(10)) != 0, F.col("c_name")).alias("name"),
        F.concat(F.lit("NATION_"), F.pmod("c_custkey", F.lit(30)).cast("string")).alias("nation"),
    )
    lookups = {"nation": (t.nation, "n_name", "n_nationkey", "nation_id")}
    _, rejects = changes.load_batch(existing, batch, ["name"], None, [F.col("name")], lookups)
    return rejects.select("name", "nation", "reject_reason")


@query(
    "append_and_read_back",
    """
SELECT s_name AS name, s_nationkey AS nation_id FROM supplier
UNION ALL SELECT c_name, c_nationkey FROM customer WHERE LOWER(c_name) NOT IN (SELECT LOWER(s_name) FROM supplier)
""",
)
def append_and_read_back(t: Tables) -> DataFrame:
    """An append to a stored table that is tried twice, as after a lost answer, and the table read back."""
    path = f"{storage.shared_folder(t.spark)}/suppliers-{uuid.uuid4().hex}"
    storage.replace_table(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id")), path)
    batch = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"))
    for _ in range(2):
        known = t.spark.read.schema(batch.schema).parquet(path)
        storage.append_table(changes.rows_to_append(known, batch, ["name"], [F.col("nation_id")]), path)
    return t.spark.read.schema(batch.schema).parquet(path)


@query(
    "append_retried",
    """
SELECT s_name AS name, s_nationkey AS nation_id FROM supplier
UNION ALL SELECT c_name, c_nationkey FROM customer WHERE LOWER(c_name) NOT IN (SELECT LOWER(s_name) FROM supplier)
UNION ALL SELECT c_name || ' jr', c_nationkey FROM customer WHERE c_custkey % 2 = 0
""",
)
def append_retried(t: Tables) -> DataFrame:
    """Three loads of a stored table, each tried twice as after a lost answer; a second try replaces the first."""
    path = f"{storage.shared_folder(t.spark)}/people-{uuid.uuid4().hex}"
    people = t.customer.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"))
    children = t.customer.filter(F.pmod("c_custkey", F.lit(2)) == 0)
    children = children.select(F.concat("c_name", F.lit(" jr")).alias("name"), F.col("c_nationkey").alias("nation_id"))
    storage.append_batch(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id")), path, "0")
    for batch_id, batch in (("1", people), ("2", children)):
        for _ in range(2):
            known = storage.stored(t.spark, path, people.schema, without=batch_id)
            storage.append_batch(changes.rows_to_append(known, batch, ["name"], [F.col("nation_id")]), path, batch_id)
    return storage.stored(t.spark, path, people.schema)


@query(
    "append_null_keys",
    """
WITH batch AS (SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name, c_nationkey AS nation_id FROM customer)
SELECT s_name AS name, s_nationkey AS nation_id FROM supplier UNION ALL SELECT name, nation_id FROM batch
""",
)
def append_null_keys(t: Tables) -> DataFrame:
    existing = t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation_id"))
    name = F.when(F.pmod("c_custkey", F.lit(10)) != 0, F.col("c_name"))
    batch = t.customer.select(name.alias("name"), F.col("c_nationkey").alias("nation_id"))
    return changes.append_missing(existing, batch, ["name"], [F.col("nation_id")], null_keys="keep")


@query(
    "keyed_update_duplicates",
    """
WITH newest AS (SELECT o_custkey, MAX(o_orderkey) AS last_order FROM orders GROUP BY o_custkey)
SELECT c_custkey, COALESCE(o_orderpriority, c_mktsegment) AS c_mktsegment
FROM customer LEFT JOIN newest ON c_custkey = newest.o_custkey LEFT JOIN orders ON o_orderkey = last_order
""",
)
def keyed_update_duplicates(t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", "c_mktsegment")
    asked = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("c_mktsegment"), "o_orderkey"
    )
    return changes.update_matched(target, asked, ["c_custkey"], ["c_mktsegment"], [F.col("o_orderkey").desc()])


_RENTING = """
WITH lines AS (SELECT o_custkey, l_partkey, l_suppkey, l_returnflag FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
requests AS (SELECT DISTINCT o_custkey, l_partkey FROM lines WHERE l_returnflag <> 'R'),
history AS (SELECT DISTINCT o_custkey, l_partkey, l_suppkey FROM lines WHERE l_returnflag = 'R'),
copies AS (SELECT DISTINCT l_partkey, l_suppkey, s_nationkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
clerk AS (SELECT s_nationkey, MIN(s_suppkey) AS staff_id FROM supplier GROUP BY s_nationkey),
asked AS (SELECT o_custkey, l_partkey, c_nationkey AS s_nationkey FROM requests JOIN customer ON c_custkey = o_custkey)
"""

_RENTED = """
numbered AS (
  SELECT given.*, staff_id, ROW_NUMBER() OVER (ORDER BY o_custkey, l_partkey, l_suppkey) AS n
  FROM given JOIN clerk USING (s_nationkey))
SELECT (SELECT MAX(o_orderkey) FROM orders) + n AS rental_id, (SELECT MAX(o_custkey) FROM orders) + n AS payment_id,
       o_custkey AS customer_id, l_partkey AS film_id, l_suppkey AS supplier_id, staff_id,
       CAST(DATE '2017-01-01' + p_size AS DATE) AS return_date, CAST(p_size AS DECIMAL(38,2)) AS amount
FROM numbered JOIN part ON l_partkey = p_partkey
"""

_EVERY_COPY = """
given AS (
  SELECT l_partkey, l_suppkey, s_nationkey, MIN(o_custkey) AS o_custkey
  FROM asked JOIN copies USING (l_partkey, s_nationkey) ANTI JOIN history USING (o_custkey, l_partkey, l_suppkey)
  GROUP BY ALL)
"""

_ONE_EACH = """
turns AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, s_nationkey ORDER BY o_custkey) AS turn FROM asked),
shelf AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, s_nationkey ORDER BY l_suppkey) AS turn FROM copies),
first_round AS (SELECT o_custkey, l_partkey, s_nationkey, l_suppkey FROM turns JOIN shelf USING (l_partkey, s_nationkey, turn)
                ANTI JOIN history USING (o_custkey, l_partkey, l_suppkey)),
waiting AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, s_nationkey ORDER BY o_custkey DESC) AS turn
            FROM asked ANTI JOIN first_round USING (o_custkey, l_partkey)),
left_over AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey, s_nationkey ORDER BY l_suppkey) AS turn
              FROM copies ANTI JOIN first_round USING (l_partkey, l_suppkey)),
given AS (SELECT * FROM first_round UNION ALL
          SELECT o_custkey, l_partkey, s_nationkey, l_suppkey FROM waiting JOIN left_over USING (l_partkey, s_nationkey, turn)
          ANTI JOIN history USING (o_custkey, l_partkey, l_suppkey))
"""


def _rent(t: Tables, one_each: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """New rentals, their payments, and the requests that nothing was rented for."""
    lines = roles.rentals(t).select("customer_id", "film_id", "inventory_id", "kind")
    if one_each:  # read many times by the steps below, each in a job of its own: joined once
        lines = storage.frozen(lines)
    requests = lines.filter(F.col("kind") != "R").select("customer_id", "film_id")
    home = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("store_id"))
    staff = t.supplier.select(F.col("s_suppkey").alias("staff_id"), F.col("s_nationkey").alias("store_id"))
    shelf = F.col("inventory_id.l_suppkey") == F.col("staff_id")
    inventory = roles.inventory(t).join(staff, shelf).drop("staff_id")
    if one_each:
        inventory = storage.frozen(inventory)
    highest = changes.highest_key(t.orders, "o_orderkey")
    before = lines.filter(F.col("kind") == "R").select("customer_id", "inventory_id")
    payment = t.orders.select(F.col("o_custkey").alias("payment_id"))
    day = dt.date(2017, 1, 1)
    film = roles.film(t)
    rentals, payments = film_rental.rent_films(
        requests, home, film, inventory, staff, before, payment, day, day, highest, one_each
    )
    return rentals, payments, film_rental.unmet_requests(requests, home, film, inventory, rentals)


def _paid(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    return payments.join(rentals.select("rental_id", "inventory_id", "return_date"), "rental_id").select(
        "rental_id",
        "payment_id",
        "customer_id",
        F.col("inventory_id.l_partkey").alias("film_id"),
        F.col("inventory_id.l_suppkey").alias("supplier_id"),
        "staff_id",
        "return_date",
        from_cents("amount_cents").alias("amount"),
    )


@query("rent_and_pay", f"{_RENTING}, {_EVERY_COPY}, {_RENTED}")
def rent_and_pay(t: Tables) -> DataFrame:
    rentals, payments, _ = _rent(t, one_each=False)
    return _paid(rentals, payments)


@query("rent_one_each", f"{_RENTING}, {_ONE_EACH}, {_RENTED}")
def rent_one_each(t: Tables) -> DataFrame:
    rentals, payments, _ = _rent(t, one_each=True)
    return _paid(rentals, payments)


@query(
    "rent_rejects",
    f"""{_RENTING}, {_ONE_EACH}
SELECT o_custkey AS customer_id, l_partkey AS film_id,
       CASE WHEN EXISTS (SELECT 1 FROM copies c WHERE c.l_partkey = asked.l_partkey AND c.s_nationkey = asked.s_nationkey)
            THEN 'no copy left' ELSE 'no copy in the store' END AS reject_reason
FROM asked ANTI JOIN given USING (o_custkey, l_partkey)
""",
)
def rent_rejects(t: Tables) -> DataFrame:
    return _rent(t, one_each=True)[2]
