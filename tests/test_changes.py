import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from salesloom.operators import changes
from salesloom.operators.lookup import in_set, map_by_rules, not_in_set, resolve_keys, split_rejects, with_counts


def names(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "name string, seq int")


def test_append_twice_adds_nothing(spark):
    base = names(spark, "Ann", "Bob")
    batch = names(spark, " ann ", "Cy", "CY", None, None)
    once = changes.append_missing(base, batch, ["name"], [F.col("seq")])
    assert rows_of(once.select("name")) == [("Ann",), ("Bob",), ("Cy",)]
    twice = changes.append_missing(once, batch, ["name"], [F.col("seq")])
    assert rows_of(twice) == rows_of(once)


def test_rows_with_a_null_key_are_all_kept_on_request(spark):
    batch = names(spark, "Cy", None, None)
    out = changes.append_missing(names(spark, "Ann"), batch, ["name"], [F.col("seq")], null_keys="keep")
    assert rows_of(out) == sorted([("Ann", 0), ("Cy", 0), (None, 1), (None, 2)], key=repr)


def test_mixed_keys_fold_text_only(spark):
    base = spark.createDataFrame([("Blue", 7)], "colour string, size int")
    batch = spark.createDataFrame([("blue", 7), ("BLUE", 8), (None, 7)], "colour string, size int")
    order, key = [F.col("colour")], ["colour", "size"]
    new, rejects = changes.load_batch(base, batch, key, None, order)
    assert rows_of(new) == [("BLUE", 8)]
    assert [r.reject_reason for r in rejects.collect()] == ["natural key is NULL"]
    again, _ = changes.load_batch(base.unionByName(new), batch, key, None, order)
    assert again.collect() == []


def test_several_changes_for_a_key_need_an_order(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    change = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, s string, seq int")
    out = changes.update_matched(target, change, ["k"], ["s"], [F.col("seq").desc()])
    assert rows_of(out) == [(1, "y"), (2, "b")]
    with pytest.raises(Exception, match="several changes"):
        changes.update_matched(target, change, ["k"], ["s"]).collect()


def test_append_uses_the_whole_composite_key(spark):
    base = spark.createDataFrame([(1, 10)], "ticket int, promo int")
    batch = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (1, 11)], "ticket int, promo int")
    out = changes.append_skip_conflict(base, batch, ["ticket", "promo"], [F.col("ticket")])
    assert rows_of(out) == [(1, 10), (1, 11), (2, 10)]


def test_exact_conflict_keeps_other_spelling(spark):
    out = changes.append_skip_conflict(names(spark, "Ann"), names(spark, "ann", "Ann"), ["name"], [F.col("seq")])
    assert rows_of(out.select("name")) == [("Ann",), ("ann",)]


@pytest.mark.parametrize("block_rows", [1, 2, 1000])
def test_missing_pairs_against_brute_force(spark, block_rows):
    items, places = range(6), "abcdefg"
    held = [(i, p) for i, p in itertools.product(items, places) if (i * 7 + ord(p)) % 3 == 0] * 3
    out = changes.missing_pairs(
        spark.createDataFrame([(i,) for i in items], "item int"),
        spark.createDataFrame([(p,) for p in places] * 2, "place string"),
        spark.createDataFrame(held, "item int, place string"),
        "item",
        "place",
        block_rows,
    )
    assert rows_of(out) == sorted(set(itertools.product(items, places)) - set(held), key=repr)


def test_missing_pairs_without_places_or_holdings(spark):
    items = spark.createDataFrame([(1,)], "item int")
    none = spark.createDataFrame([], "item int, place string")
    assert rows_of(changes.missing_pairs(items, none, none, "item", "place")) == []
    places = spark.createDataFrame([("a",)], "place string")
    assert rows_of(changes.missing_pairs(items, places, none, "item", "place")) == [(1, "a")]


def test_update_overwrites_matched_rows_also_with_null(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, s string, v double")
    change = spark.createDataFrame([(2, None, 9.0), (3, "z", 0.0)], "k int, s string, v double")
    assert rows_of(changes.update_matched(target, change, ["k"], ["s"])) == [(1, "a", 1.0), (2, None, 2.0)]


def test_field_changes_last_one_wins(spark):
    target = spark.createDataFrame([(1, "Pending", dt.date(2024, 1, 1)), (2, "Pending", None)], "id int, status string, day date")
    change = spark.createDataFrame(
        [(1, "status", "Shipped", 1), (1, "status", "Completed", 2), (2, "day", "2024-05-06", 1), (1, "day", None, 3)],
        "id int, column_name string, new_value string, seq int",
    )
    out = changes.apply_field_changes(target, change, "id", {"status": "string", "day": "date"}, "seq")
    assert rows_of(out) == [(1, "Completed", None), (2, "Pending", dt.date(2024, 5, 6))]


def test_field_change_with_bad_text_fails(spark):
    target = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "id int, day date")
    change = spark.createDataFrame([(1, "day", "never", 1)], "id int, column_name string, new_value string, seq int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        changes.apply_field_changes(target, change, "id", {"day": "date"}, "seq").collect()


def test_change_of_a_protected_column_fails(spark):
    target = spark.createDataFrame([(1, "x")], "id int, status string")
    change = spark.createDataFrame([(1, "id", "2", 1)], "id int, column_name string, new_value string, seq int")
    with pytest.raises(Exception, match="column cannot be changed: id"):
        changes.apply_field_changes(target, change, "id", {"status": "string"}, "seq").collect()


def test_delete_keeps_rows_without_key(spark):
    target = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    gone = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows_of(changes.delete_keys(target, gone, ["k"])) == [(1,), (None,)]


def test_keys_continue_after_the_highest(spark):
    batch = spark.createDataFrame([("b",), ("a",)], "name string")
    existing = spark.createDataFrame([(4,), (9,)], "id int")
    assert rows_of(changes.assign_keys(existing, batch, "id", [F.col("name")])) == [("a", 10), ("b", 11)]
    nothing = existing.filter("id > 100")
    assert rows_of(changes.assign_keys(nothing, batch, "id", [F.col("name")])) == [("a", 1), ("b", 2)]


def test_new_headers_are_idempotent(spark):
    headers = spark.createDataFrame([(7, 1, 1)], "rental_id int, customer int, copy int")
    wanted = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1)], "customer int, copy int")
    key, order = ["customer", "copy"], [F.col("customer"), F.col("copy")]
    fresh = changes.new_headers(headers, wanted, key, "rental_id", order)
    assert rows_of(fresh) == [(1, 2, 8), (2, 1, 9)]
    after = headers.unionByName(fresh.withColumn("rental_id", F.col("rental_id").cast("int")))
    assert rows_of(changes.new_headers(after, wanted, key, "rental_id", order)) == []


def test_audit_column_keeps_old_values(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None)], "id int, record_ts date")
    stamp = F.lit(dt.date(2024, 1, 1))
    assert rows_of(changes.with_audit_column(df, stamp)) == [(1, dt.date(2020, 1, 1)), (2, dt.date(2024, 1, 1))]
    assert changes.with_audit_column(df.select("id"), stamp).columns == ["id", "record_ts"]


def test_resolve_keeps_rows_and_names_the_unknown_key(spark):
    batch = spark.createDataFrame([(1, "x", "p"), (2, "nope", "p"), (3, "x", None)], "id int, customer string, product string")
    customers = spark.createDataFrame([(5, "x"), (4, "x"), (6, None)], "cid int, name string")
    products = spark.createDataFrame([(8, "p")], "pid int, title string")
    out = resolve_keys(
        batch,
        {"customer": (customers, "name", "cid", "customer_id"), "product": (products, "title", "pid", "product_id")},
    )
    good, bad = split_rejects(out)
    assert rows_of(good.select("id", "customer_id", "product_id")) == [(1, 4, 8)]
    assert rows_of(bad.select("id", "reject_reason")) == [(2, "customer not found"), (3, "product not found")]


def test_rules_pair_rows_without_case_and_once(spark):
    rules = spark.createDataFrame([("Sunrise", "lee"), ("sunrise", "LEE"), ("tides", "kim")], "film string, actor string")
    films = spark.createDataFrame([(1, "SUNRISE"), (2, "Tides"), (3, "Other")], "fid int, title string")
    actors = spark.createDataFrame([(1, "Lee"), (2, "Kim"), (3, "lee")], "aid int, name string")
    pairs = map_by_rules(rules, films, actors, {"film": "title"}, {"actor": "name"})
    assert rows_of(pairs.select("fid", "aid")) == [(1, 1), (1, 3), (2, 2)]


def test_membership_and_counts(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    members = spark.createDataFrame([(2,), (2,), (None,)], "k int")
    assert rows_of(in_set(df, members, "k")) == [(2,)]
    assert rows_of(not_in_set(df, members, "k")) == [(1,), (None,)]
    assert rows_of(with_counts(df, members, "k", "n")) == [(1, 0), (2, 2), (None, 0)]


def test_batch_load_by_names_twice(spark):
    lines = spark.createDataFrame([(1, "Harbour Line", "Red")], "line_id int, line_name string, line_color string")
    batch = spark.createDataFrame([("HARBOUR LINE", "x"), ("Ring Line", "Yellow")], "line_name string, line_color string")
    order = [F.col("line_name")]
    new, rejects = changes.load_batch(lines, batch, ["line_name"], "line_id", order)
    assert rows_of(new) == [(2, "Ring Line", "Yellow")] and rejects.collect() == []
    lines = lines.unionByName(new)
    assert changes.load_batch(lines, batch, ["line_name"], "line_id", order)[0].collect() == []

    stops = spark.createDataFrame([(1, 7, 1)], "line_id int, station_id int, stop_sequence int")
    stations = spark.createDataFrame([(7, "North"), (8, "South")], "station_id int, station_name string")
    stop_batch = spark.createDataFrame(
        [("Harbour Line", "North", 1), ("Harbour Line", "South", 2), ("Ring Line", "South", 1), ("Harbour Line", "Nowhere", 3)],
        "line string, station string, stop_sequence int",
    )
    lookups = {
        "line": (lines, "line_name", "line_id", "line_id"),
        "station": (stations, "station_name", "station_id", "station_id"),
    }
    key = ["line_id", "station_id"]
    new, rejects = changes.load_batch(stops, stop_batch, key, None, [F.col("stop_sequence")], lookups)
    assert rows_of(new) == [(1, 8, 2), (2, 8, 1)]
    assert [r.reject_reason for r in rejects.collect()] == ["station not found"]
