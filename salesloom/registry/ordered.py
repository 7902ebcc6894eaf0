"""Frames, positions and as-of lookups over raw rows, where a window would run in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.functions.money import cents, from_cents
from salesloom.operators import ordered
from salesloom.operators.ordered import By
from salesloom.registry import query
from salesloom.sources.tables import Tables


def _events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "event_type", "ts", cents("value").alias("amount"))


@query(
    "asof_previous_order",
    """
WITH asked AS (SELECT event_id, user_id, ts, event_type FROM events WHERE event_type <> 'click'),
clicks AS (SELECT event_id, user_id, ts, CAST(value AS DECIMAL(12,2)) AS value FROM events WHERE event_type = 'click')
SELECT asked.event_id, user_id AS customer_id, asked.event_type, asked.ts,
       ARG_MAX(clicks.event_id, (clicks.ts, clicks.event_id)) AS click_id,
       CAST(ARG_MAX(clicks.value, (clicks.ts, clicks.event_id)) AS DECIMAL(38,2)) AS click_value
FROM asked LEFT JOIN clicks USING (user_id)
WHERE clicks.ts IS NULL OR clicks.ts <= asked.ts GROUP BY ALL
UNION ALL
SELECT event_id, user_id, event_type, ts, NULL, NULL FROM asked
WHERE EXISTS (SELECT 1 FROM clicks WHERE clicks.user_id = asked.user_id)
  AND NOT EXISTS (SELECT 1 FROM clicks WHERE clicks.user_id = asked.user_id AND clicks.ts <= asked.ts)
""",
)
def asof_previous_order(t: Tables) -> DataFrame:
    """Every other event with its user's last click up to then."""
    events = _events(t)
    clicks = events.filter(F.col("event_type") == "click")
    clicks = clicks.select("user_id", "ts", F.col("event_id").alias("click_id"), F.col("amount").alias("click_amount"))
    asked = events.filter(F.col("event_type") != "click").select("event_id", "user_id", "event_type", "ts")
    found = ordered.asof_join(asked, clicks, ["user_id"], "ts", "ts", ["click_id", "click_amount"], tie=["click_id"])
    return found.select(
        "event_id", F.col("user_id").alias("customer_id"), "event_type", "ts", "click_id",
        from_cents("click_amount").alias("click_value"),
    )


@query(
    "asof_next_order",
    """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_day,
       LEAD(o_orderkey) OVER w AS next_order, CAST(LEAD(o_orderdate) OVER w AS DATE) AS next_day
FROM (SELECT * FROM orders WHERE o_orderkey IN (
        SELECT MIN(o_orderkey) FROM orders GROUP BY o_custkey, o_orderdate))
WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate)
""",
)
def asof_next_order(t: Tables) -> DataFrame:
    """The first order of a customer's day with the first order of their next day: an inequality join with payload."""
    orders = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.min("o_orderkey").alias("o_orderkey"))
    later = orders.select("o_custkey", F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("next_order"))
    later = later.withColumn("next_date", F.col("day"))
    found = ordered.asof_join(
        orders, later, ["o_custkey"], "o_orderdate", "day", ["next_order", "next_date"], forward=True, same_time=False
    )
    return found.select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"), "next_order",
        F.to_date("next_date").alias("next_day"),
    )


@query(
    "event_running_value",
    """
SELECT event_id, ts, SUM(CAST(value AS DECIMAL(12,2))) OVER (ORDER BY ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_value
FROM events
""",
)
def event_running_value(t: Tables) -> DataFrame:
    totals = ordered.running_totals(_events(t), ["ts", "event_id"], {"running": "amount"})
    return totals.select("event_id", "ts", from_cents("running").alias("running_value"))


@query(
    "event_centred_value",
    """
SELECT event_id, AVG(CAST(ROUND(value * 100) AS BIGINT)) OVER w AS mean_cents,
       CAST(MAX(CAST(value AS DECIMAL(12,2))) OVER w AS DECIMAL(38,2)) AS greatest
FROM events WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
""",
)
def event_centred_value(t: Tables) -> DataFrame:
    frames = {"mean_cents": F.avg("amount"), "_greatest": F.max("amount")}
    framed = ordered.rows_frame(_events(t), ["ts", "event_id"], frames, before=1, after=1, block_rows=1000)
    return framed.select("event_id", "mean_cents", from_cents("_greatest").alias("greatest"))


@query(
    "event_trailing_hours",
    """
SELECT event_id, SUM(CAST(value AS DECIMAL(12,2))) OVER (ORDER BY ts
                   RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS last_six_hours
FROM events
""",
)
def event_trailing_hours(t: Tables) -> DataFrame:
    totals = ordered.range_total(_events(t), "ts", F.make_dt_interval(hours=F.lit(6)), "amount", "recent")
    return totals.select("event_id", from_cents("recent").alias("last_six_hours"))


@query(
    "order_day_groups",
    """
SELECT o_orderkey, DENSE_RANK() OVER (ORDER BY CAST(o_orderdate AS DATE)) AS day_number,
       SUM(CAST(o_totalprice AS DECIMAL(12,2))) OVER (ORDER BY CAST(o_orderdate AS DATE)
         GROUPS BETWEEN 2 PRECEDING AND CURRENT ROW) AS last_three_days
FROM orders
""",
)
def order_day_groups(t: Tables) -> DataFrame:
    """Raw orders with the sum over their day and the two order days before it."""
    orders = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), cents("o_totalprice").alias("amount"))
    framed = ordered.groups_total(orders, "day", 2, "amount", "recent", block_rows=100)
    ranked = ordered.dense_ranked(framed, "day", "day_number")
    return ranked.select("o_orderkey", "day_number", from_cents("recent").alias("last_three_days"))


@query(
    "middle_line",
    """
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(38,2)) AS price FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 1 OFFSET (SELECT COUNT(*) // 2 FROM lineitem)
""",
)
def middle_line(t: Tables) -> DataFrame:
    """The line in the middle of all lines by price."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    middle = t.lineitem.agg(F.floor(F.count(F.lit(1)) / 2)).scalar()
    row = ordered.nth_row(lines, [By("l_extendedprice", descending=True), "l_orderkey", "l_linenumber"], middle)
    return row.select("l_orderkey", "l_linenumber", from_cents(cents("l_extendedprice")).alias("price"))


@query(
    "customer_order_numbers",
    """
SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number
FROM orders
""",
)
def customer_order_numbers(t: Tables) -> DataFrame:
    """Orders numbered per customer, customers of any size."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    numbered = ordered.numbers_within(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "order_number")
    return numbered.drop("o_orderdate")
