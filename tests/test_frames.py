import datetime as dt

from salesloom.functions.dates import calendar_of
from salesloom.operators import frames
from salesloom.operators.gaps import adjacent_values, longest_gap, longest_gap_by_set
from salesloom.operators.pivots import crosstab

from helpers import rows_of

DAY = dt.date(2000, 1, 1)


def days(*offsets):
    return [(DAY + dt.timedelta(days=o), 10 + o) for o in offsets]


def test_rows_and_calendar_frames_differ_on_missing_days(spark):
    data = days(0, 1, 2, 9, 10)
    df = spark.createDataFrame(data, "d date, v int")
    framed = df.select(
        "d",
        frames.trailing_rows_sum("v", "d", 2).alias("rows"),
        frames.trailing_days_sum("v", "d", 6).alias("days"),
    )
    for d, by_rows, by_days in rows_of(framed):
        position = [x for x, _ in data].index(d)
        assert by_rows == sum(v for _, v in data[max(0, position - 2) : position + 1])
        assert by_days == sum(v for x, v in data if dt.timedelta(0) <= d - x <= dt.timedelta(days=6))


def test_peer_groups_enter_the_frame_whole(spark):
    data = [(1, "a", 1), (1, "b", 2), (3, "c", 4), (4, "d", 8), (4, "e", 16), (9, "f", 32)]
    df = spark.createDataFrame(data, "g int, name string, v int")
    out = frames.trailing_groups_sum(df, "v", "g", 2, "s")
    groups = sorted({g for g, _, _ in data})
    expected = [
        (g, n, v, sum(w for h, _, w in data if h in groups[max(0, groups.index(g) - 2) : groups.index(g) + 1]))
        for g, n, v in data
    ]
    assert rows_of(out) == sorted(expected, key=repr)


def test_running_sum_restarts_and_average_shrinks_at_the_edges(spark):
    df = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 3, 60)], "w int, d int, v int")
    out = df.select("d", frames.running_sum("v", "d", ["w"]), frames.centred_average("v", "d"))
    assert rows_of(out) == [(1, 10, 15.0), (2, 30, 30.0), (3, 60, 40.0)]


def test_previous_and_next_value(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4), ("b", 2)], "k string, v int")
    out = df.select("k", "v", frames.previous_value("v", "v", ["k"]), frames.next_value("v", ["k"]))
    assert rows_of(out) == [("a", 1, None, 4), ("a", 4, 1, None), ("b", 2, None, None)]


def test_gap_forms_agree_with_pairs_without_a_row_between(spark):
    years = [("x", y) for y in (1990, 1990, 1993, 2000)] + [("y", 2001)] + [("z", None), ("z", 5), ("z", 6)]
    df = spark.createDataFrame(years, "k string, y int")
    distinct = {(k, y) for k, y in years if y is not None}
    pairs = {
        (k, a, b)
        for k, a in distinct
        for j, b in distinct
        if j == k and a < b and not any(i == k and a < c < b for i, c in distinct)
    }
    assert rows_of(adjacent_values(df, "k", "y")) == sorted(pairs, key=repr)
    expected = sorted(((k, max(b - a for i, a, b in pairs if i == k)) for k in {p[0] for p in pairs}), key=repr)
    assert rows_of(longest_gap(df, "k", "y")) == expected
    assert rows_of(longest_gap_by_set(df, "k", "y")) == expected


def test_crosstab_fills_missing_cells_and_totals_the_row(spark):
    df = spark.createDataFrame([(1, "p", 1, 5), (1, "p", 1, 6), (1, "p", 4, 7), (2, "q", 3, 1)], "id int, n string, q int, v int")
    out = crosstab(df, ["id", "n"], "q", [1, 2, 3, 4], "v", ["q1", "q2", "q3", "q4"], "total")
    assert rows_of(out) == [(1, "p", 11, 0, 0, 7, 18), (2, "q", 0, 0, 1, 0, 1)]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 12, 31, 5),), (dt.datetime(2000, 1, 1, 1),), (None,)], "t timestamp_ntz")
    assert rows_of(calendar_of(df, "t")) == [
        (dt.date(1999, 12, 31), 1999, 4, 12, "1999-12", 52, "Friday"),
        (dt.date(2000, 1, 1), 2000, 1, 1, "2000-01", 52, "Saturday"),
    ]
