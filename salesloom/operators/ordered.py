"""Work on one long ordered relation, spread over tasks: numbers, running totals, frames, nth row, as-of join.

A window without partition columns runs in one task, one with them in one task per key. Here the ordered rows are cut
into slices, ranges of the order's values. The borders are quantiles of the rows whose order columns have the smallest
hashes (a fixed number per slice), found inside the plan by a scalar subquery: nothing is written or run while a plan
is built, and as borders and slices depend on values only, every evaluation of a plan gives the same rows. What crosses
a border, a count, a total or a last row, is one row per slice and is carried over in a broadcast table of that size.

``order`` lists column names (ascending, NULLs first), ``By`` values, or plain columns with or without a sort
direction; it should identify a row. Rows equal in all order columns are in one slice. Helper columns start with an
underscore.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Rows of the sample per slice; a slice holds about its share of all rows.
SAMPLED_PER_SLICE = 50
#: Rows of a block of a frame by rows.
BLOCK_ROWS = 100_000
#: Groups of a numbering are counted together in this many parts by a hash; the groups of a part with more rows than
#: ``CROWD_ROWS`` are numbered in slices, all others in one task per group.
GROUP_PARTS = 1 << 16
CROWD_ROWS = 1_000_000

_SORTED = re.compile(r"Column<'`?(.+?)`?(?: (ASC|DESC) NULLS (FIRST|LAST))?'>")


@dataclass(frozen=True)
class By:
    """An order column. NULLs come first in ascending and last in descending order unless said otherwise."""

    column: str
    descending: bool = False
    nulls_first: bool | None = None

    @staticmethod
    def of(item: str | Column | By) -> By:
        if isinstance(item, By):
            return item
        if isinstance(item, str):
            return By(item)
        name, direction, nulls = _SORTED.fullmatch(str(item)).groups()
        return By(name, direction == "DESC", None if nulls is None else nulls == "FIRST")

    @property
    def _first(self) -> bool:
        return not self.descending if self.nulls_first is None else self.nulls_first

    def sort(self, of: Column | None = None) -> Column:
        column = F.col(self.column) if of is None else of
        if self.descending:
            return column.desc_nulls_first() if self._first else column.desc_nulls_last()
        return column.asc_nulls_first() if self._first else column.asc_nulls_last()

    def before(self, a: Column, b: Column) -> Column:
        """Whether value ``a`` comes before value ``b``; never NULL."""
        ordered = a > b if self.descending else a < b
        return (
            F.when(a.isNull(), b.isNotNull() if self._first else F.lit(False))
            .when(b.isNull(), F.lit(not self._first))
            .otherwise(ordered)
        )


Order = Sequence["str | Column | By"]


def _bounds(df: DataFrame, by: list[By], slices: int) -> Column:
    """The greatest rows of all slices but the last as one array, in order; a value, of at most ``slices`` rows."""
    keys = [f"_k{i}" for i in range(len(by))]
    sample = (
        df.select(*[F.col(b.column).alias(k) for b, k in zip(by, keys)])
        .withColumn("_hash", F.xxhash64(*keys))
        .orderBy("_hash", *keys)
        .limit(SAMPLED_PER_SLICE * slices)
    )
    ordered = Window.orderBy(*[b.sort(F.col(k)) for b, k in zip(by, keys)])  # the sample's rows only
    placed = sample.select(*keys, F.row_number().over(ordered).alias("_n"), F.ntile(slices).over(ordered).alias("_tile"))
    last = placed.withColumn("_next", F.lead("_tile").over(Window.orderBy("_n"))).filter(F.col("_next") > F.col("_tile"))
    return last.agg(F.sort_array(F.collect_list(F.struct("_n", F.struct(*keys).alias("_row"))))).scalar()


def sliced(df: DataFrame, order: Order, column: str = "_slice", slices: int | None = None) -> DataFrame:
    """Add the number (from 0) of the range of ``order`` that a row falls into; all rows of a slice come before the next.

    There are as many slices as shuffle partitions unless given.
    """
    by = [By.of(item) for item in order]
    if slices is None:
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if slices < 2:
        return df.withColumn(column, F.lit(0))
    steps = F.array(*[F.lit(1 << i) for i in range(slices.bit_length() - 1, -1, -1)])
    plain = all(b._first and not b.descending for b in by)  # the order of structs

    def passed(bound: Column) -> Column:
        if plain:
            return bound < F.col("_sought")
        found = F.lit(False)
        for i, b in reversed(list(enumerate(by))):
            value = F.col(b.column)
            same = bound[f"_k{i}"].eqNullSafe(value)
            found = b.before(bound[f"_k{i}"], value) | (same & found)
        return found

    def narrowed(low: Column, step: Column) -> Column:  # binary search for the number of bounds before the row
        inside = (low + step <= F.size("_bounds")) & passed(F.get("_bounds", low + step - 1)["_row"])
        return F.when(inside, low + step).otherwise(low)

    row = F.struct(*[F.col(b.column).alias(f"_k{i}") for i, b in enumerate(by)])
    with_bounds = df.withColumn("_bounds", _bounds(df, by, slices)).withColumn("_sought", row)
    return with_bounds.withColumn(column, F.aggregate(steps, F.lit(0), narrowed)).drop("_bounds", "_sought")


def _within(by: list[By], slice_column: str = "_slice") -> WindowSpec:
    return Window.partitionBy(slice_column).orderBy(*[b.sort() for b in by])


def _carried(per_slice: DataFrame, carried: Mapping[str, Column]) -> DataFrame:
    """_slice and what all earlier slices bring; one row per slice, so it may be broadcast."""
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per_slice.select("_slice", *[c.over(before).alias(name) for name, c in carried.items()]))


def number_rows(df: DataFrame, order: Order, column: str = "row_num") -> DataFrame:
    """Consecutive numbers 1, 2, ... over the whole relation in ``order``."""
    by = [By.of(item) for item in order]
    cut = sliced(df, by)
    counts = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = _carried(counts, {"_offset": F.sum("_rows")})
    local = cut.withColumn("_local", F.row_number().over(_within(by)))
    return (
        local.join(offsets, "_slice", "left")
        .withColumn(column, F.coalesce("_offset", F.lit(0)) + F.col("_local"))
        .drop("_slice", "_offset", "_local")
    )


def number_rows_by(df: DataFrame, first: str, order: Order, column: str) -> DataFrame:
    """``number_rows`` in the order of ``first`` (ascending, NULLs first), then ``order``.

    For a first column with far fewer values than rows: only these are cut into slices, with a running total of their
    rows; the rows are numbered within their value (see ``numbers_within``).
    """
    sizes = df.groupBy(F.col(first).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    upto = running_totals(sizes, ["_value"], {"_upto": "_rows"})
    offsets = upto.select("_value", (F.col("_upto") - F.col("_rows")).alias("_offset"))
    numbered = numbers_within(df, [first], order, "_local")
    joined = numbered.join(offsets, F.col(first).eqNullSafe(F.col("_value")))
    return joined.withColumn(column, F.col("_offset") + F.col("_local")).drop("_value", "_offset", "_local")


def numbers_within(df: DataFrame, group: Sequence[str], order: Order, column: str) -> DataFrame:
    """Row numbers 1, 2, ... of each group, of any size. Groups with a NULL are groups as well.

    Groups are numbered in one task each, in one shuffle. Those in a crowded part of the groups are numbered in slices:
    the number over all of them less the group's first one.
    """
    by = [By.of(item) for item in order]
    parted = df.withColumn("_part", F.pmod(F.xxhash64(*group), F.lit(GROUP_PARTS)))
    sizes = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    crowded = F.broadcast(sizes.filter(F.col("_rows") > CROWD_ROWS).select("_part"))  # at most a row per CROWD_ROWS rows
    quiet = parted.join(crowded, "_part", "left_anti").drop("_part")
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*[b.sort() for b in by])).cast("long")
    busy = parted.join(crowded, "_part", "left_semi").drop("_part")
    return quiet.withColumn(column, place).unionByName(_numbers_in_slices(busy, group, by, column))


def _numbers_in_slices(df: DataFrame, group: Sequence[str], order: Order, column: str) -> DataFrame:
    numbered = number_rows(df, [*group, *order], "_number")
    marks = [f"_group_{i}" for i in range(len(group))]
    firsts = numbered.groupBy(*[F.col(c).alias(m) for c, m in zip(group, marks)]).agg(F.min("_number").alias("_first"))
    same = F.lit(True)
    for c, m in zip(group, marks):
        same = same & F.col(c).eqNullSafe(F.col(m))
    joined = numbered.join(firsts, same).withColumn(column, F.col("_number") - F.col("_first") + 1)
    return joined.drop("_number", "_first", *marks)


def nth_row(df: DataFrame, order: Order, n: int | Column) -> DataFrame:
    """The row at position ``n`` (from 0) of the ordered relation; no row beyond its end.

    The sizes of the slices say which one holds the position; only that slice is sorted.
    """
    by = [By.of(item) for item in order]
    cut = sliced(df, by)
    position = F.lit(n).cast("long") if isinstance(n, int) else n.cast("long")
    counts = cut.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    upto = counts.withColumn("_upto", F.sum("_rows").over(Window.orderBy("_slice")))  # one row per slice
    upto = upto.withColumn("_position", position)
    held = upto.filter((F.col("_position") >= F.col("_upto") - F.col("_rows")) & (F.col("_position") < F.col("_upto")))
    place = held.select(F.struct("_slice", (F.col("_position") - F.col("_upto") + F.col("_rows") + 1).alias("_local")))
    place = place.scalar()
    chosen = cut.withColumn("_place", place).filter(F.col("_slice") == F.col("_place._slice"))
    chosen = chosen.withColumn("_local", F.row_number().over(_within(by)))
    return chosen.filter(F.col("_local") == F.col("_place._local")).drop("_slice", "_place", "_local")


def running_totals(df: DataFrame, order: Order, totals: Mapping[str, str]) -> DataFrame:
    """Add sums over all rows up to the current one; ``totals`` maps new columns to the ones added up.

    Sums are exact for whole numbers and decimals. As in SQL a sum without any value is NULL.
    """
    by = [By.of(item) for item in order]
    cut = sliced(df, by)
    sums = {name: F.sum(value) for name, value in totals.items()}
    per_slice = cut.groupBy("_slice").agg(*[s.alias(name) for name, s in sums.items()])
    offsets = _carried(per_slice, {f"_before_{name}": F.sum(name) for name in sums})
    upto = _within(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"_own_{name}": s.over(upto) for name, s in sums.items()})
    local = local.join(offsets, "_slice", "left")

    def added(name: str) -> Column:
        own, before = F.col(f"_own_{name}"), F.col(f"_before_{name}")
        return F.when(own.isNull(), before).when(before.isNull(), own).otherwise(own + before)

    helpers = [f"_{kind}_{name}" for name in sums for kind in ("own", "before")]
    return local.withColumns({name: added(name) for name in sums}).drop("_slice", *helpers)


def rows_frame(
    df: DataFrame,
    order: Order,
    columns: Mapping[str, Column],
    before: int,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add aggregates over the ``before`` rows before each row, the row and the ``after`` rows after it.

    Rows are numbered and cut into blocks of equal size; the rows next to a border also go to the neighbouring block.
    """
    size = max(block_rows, before, after, 1)
    numbered = number_rows(df, order, "_n")
    block, place = F.floor((F.col("_n") - 1) / size), F.pmod(F.col("_n") - 1, F.lit(size))
    lent = F.struct((block + 1).alias("block"), F.lit(True).alias("lent"))
    borrowed = F.struct((block - 1).alias("block"), F.lit(True).alias("lent"))
    copies = [
        F.struct(block.alias("block"), F.lit(False).alias("lent")),
        F.when(place >= size - before, lent),
        F.when((place < after) & (block > 0), borrowed),
    ]
    spread = numbered.withColumn("_copy", F.explode(F.array_compact(F.array(*copies))))
    window = Window.partitionBy("_copy.block").orderBy("_n").rowsBetween(-before, after)
    framed = spread.withColumns({name: aggregate.over(window) for name, aggregate in columns.items()})
    return framed.filter(~F.col("_copy.lent")).drop("_copy", "_n")


def _peer_totals(df: DataFrame, order: str, value: str) -> DataFrame:
    return df.groupBy(F.col(order).alias("_at")).agg(F.sum(value).alias("_sum"), F.count(value).alias("_values"))


def _by_peer(df: DataFrame, order: str, totals: DataFrame, column: str) -> DataFrame:
    """Give every row the total of its peers. Plain join: peers of one value may be many, the join is split."""
    totals = totals.select(F.col("_at").alias("_peer"), F.col(column).alias("_total"))
    joined = df.join(totals, F.col(order).eqNullSafe(F.col("_peer")))
    return joined.withColumn(column, F.col("_total")).drop("_peer", "_total")


def range_total(df: DataFrame, order: str, reach: Column, value: str, column: str) -> DataFrame:
    """Add the sum over all rows whose order value is within ``reach`` before the row's own, which included.

    ``reach`` is what is taken off an order value: a number, or an interval for dates and times. Peers are totalled
    first. The sum of a range is the running total at its end less the one before its start; the starts are sorted in
    with the values, so both come from one running total. Rows without an order value are each other's peers.
    """
    totals = _peer_totals(df, order, value)
    dated = totals.filter(F.col("_at").isNotNull())
    point = F.struct(F.col("_at").alias("at"), F.lit(1).alias("side"), F.col("_sum").alias("sum"), F.col("_values").alias("values"))
    no_value = F.lit(None).cast(dict(totals.dtypes)["_sum"])
    start = F.struct((F.col("_at") - reach).alias("at"), F.lit(0).alias("side"), no_value.alias("sum"), F.lit(0).cast("long").alias("values"))
    points = dated.select(F.col("_at").alias("_of"), F.explode(F.array(start, point)).alias("_p"))
    points = points.select("_of", "_p.at", "_p.side", "_p.sum", "_p.values")
    running = running_totals(points, ["at", "side", "_of"], {"_sums": "sum", "_counts": "values"})

    def at(side: int, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    zero = F.lit(0).cast(dict(totals.dtypes)["_sum"])
    total = F.coalesce(at(1, "_sums"), zero) - F.coalesce(at(0, "_sums"), zero)
    held = at(1, "_counts") > F.coalesce(at(0, "_counts"), F.lit(0))
    ranges = running.groupBy(F.col("_of").alias("_at")).agg(F.when(held, total).alias(column))
    undated = totals.filter(F.col("_at").isNull()).select("_at", F.col("_sum").alias(column))
    return _by_peer(df, order, ranges.unionByName(undated), column)


def groups_total(df: DataFrame, order: str, groups: int, value: str, column: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add the sum over the row's peer group (rows of its order value) and the ``groups`` peer groups before it.

    Peer groups become one row each; the frame by groups is a frame by rows over them.
    """
    totals = _peer_totals(df, order, value)
    framed = rows_frame(totals, ["_at"], {column: F.sum("_sum")}, groups, block_rows=block_rows)
    return _by_peer(df, order, framed, column)


def dense_ranked(df: DataFrame, order: str | Column | By, column: str) -> DataFrame:
    """Add the dense rank of the order value over the whole relation: its distinct values are numbered and joined."""
    by = By.of(order)
    values = df.select(F.col(by.column).alias("_peer")).distinct()
    ranks = number_rows(values, [By("_peer", by.descending, by.nulls_first)], "_rank")
    joined = df.join(ranks, F.col(by.column).eqNullSafe(F.col("_peer")))
    return joined.withColumn(column, F.col("_rank")).drop("_peer", "_rank")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    tie: Sequence[str] = (),
    forward: bool = False,
    same_time: bool = True,
    slices: int | None = None,
) -> DataFrame:
    """Each row of ``left`` with ``columns`` of the last row of ``right`` with its keys at or before its time.

    With ``forward`` it is the first row at or after it; without ``same_time`` rows of the same time don't count. Of
    several rows of that time the greatest ``tie`` counts (the smallest with ``forward``). Rows of ``left`` without a
    match, key or time get NULLs.

    Both sides are sorted into one relation by keys and time and cut into slices, in which a window carries the last
    right row along: no pairs are made, and a key of any size is spread over slices. What a slice takes over from the
    slices before it is their last right row, if it has the same keys.
    """
    if set(columns) & set(left.columns):
        raise ValueError("columns of the right side must not be in the left side")
    keys = [f"_key_{i}" for i in range(len(on))]

    def known(df: DataFrame, time: str) -> Column:
        found = F.col(time).isNotNull()
        for key in on:
            found = found & F.col(key).isNotNull()
        return found

    rows = left.withColumn("_row", F.struct(*left.columns)).withColumn("_known", known(left, left_time))
    asked = rows.filter("_known").select(
        *[F.col(key).alias(k) for key, k in zip(on, keys)], F.col(left_time).alias("_time"), "_row"
    )
    offered = right.filter(known(right, right_time)).select(
        *[F.col(key).alias(k) for key, k in zip(on, keys)],
        F.col(right_time).alias("_time"),
        *[F.col(c).alias(f"_tie_{i}") for i, c in enumerate(tie)],
        F.struct(*columns).alias("_payload"),
    )
    # At one time, rows that count come before the row that asks.
    first, second = (0, 1) if same_time else (1, 0)
    both = offered.withColumn("_side", F.lit(first)).unionByName(
        asked.withColumn("_side", F.lit(second)), allowMissingColumns=True
    )
    ties = [f"_tie_{i}" for i in range(len(tie))]
    by = [By(c, descending=forward) for c in (*keys, "_time")] + [By("_side")] + [By(c, descending=forward) for c in ties]
    cut = sliced(both, by, slices=slices)
    upto = Window.partitionBy("_slice", *keys).orderBy(*[b.sort() for b in by[len(keys) :]])
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumn("_own", F.last("_payload", ignorenulls=True).over(upto))
    offer = F.col("_payload").isNotNull()
    last_place = F.when(offer, F.struct(*keys, "_time", *ties))
    last_row = F.struct(F.struct(*keys).alias("_keys"), F.col("_payload").alias("_last"))
    ends = cut.groupBy("_slice").agg((F.min_by if forward else F.max_by)(last_row, last_place).alias("_end"))
    carried = _carried(ends, {"_carry": F.last("_end", ignorenulls=True)})
    asking = local.filter(F.col("_row").isNotNull()).join(carried, "_slice", "left")
    taken = F.when(F.col("_carry._keys") == F.struct(*keys), F.col("_carry._last"))
    found = asking.select("_row.*", F.coalesce("_own", taken).alias("_found"))
    result = found.select(*left.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])
    types = dict(right.dtypes)
    unknown = rows.filter(~F.col("_known")).select(*left.columns, *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return result.unionByName(unknown)
