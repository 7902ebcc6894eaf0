"""Data-change jobs: snapshots in, a new snapshot out, every row in one pass."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.functions.text import folded
from salesloom.operators.lookup import in_set, not_in_set, resolve_keys, split_rejects
from salesloom.operators.ordered import By, number_rows, number_rows_by
from salesloom.operators.ranking import latest_per_key


def split_null_keys(batch: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose natural key is complete, rows with a NULL key part)."""
    complete = functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    return batch.filter(complete), batch.filter(~complete)


def rows_to_append(
    existing: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    fold: bool = True,
    null_keys: Literal["leave out", "keep"] = "leave out",
) -> DataFrame:
    """Rows of ``batch`` whose natural key is not in ``existing``; the first row per key in ``order`` wins.

    With ``fold`` the text columns of the key are compared trimmed and without case, otherwise everything is
    compared exactly. Give the whole composite key. A row with a NULL key part equals no other row: such rows
    are left out, or with ``null_keys="keep"`` all of them are appended, again at every run.
    """
    complete, incomplete = split_null_keys(batch, key)
    text = {name for name, kind in batch.dtypes if kind == "string"}
    marks = [f"_key_{i}" for i in range(len(key))]
    keyed = {mark: folded(c) if fold and c in text else F.col(c) for mark, c in zip(marks, key)}
    known = existing.select(*[expression.alias(mark) for mark, expression in keyed.items()])
    fresh = not_in_set(complete.withColumns(keyed), known, marks)
    fresh = latest_per_key(fresh, marks, order).drop(*marks)
    return fresh.unionByName(incomplete) if null_keys == "keep" else fresh


def append_missing(
    existing: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    null_keys: Literal["leave out", "keep"] = "leave out",
) -> DataFrame:
    """Idempotent append: running it again with the same batch adds nothing (but kept rows with NULL keys)."""
    return existing.unionByName(rows_to_append(existing, batch, key, order, null_keys=null_keys))


def append_skip_conflict(
    existing: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[Column],
    null_keys: Literal["leave out", "keep"] = "leave out",
) -> DataFrame:
    """Append that skips rows whose exact key is taken, by ``existing`` or earlier in the batch."""
    return existing.unionByName(rows_to_append(existing, batch, key, order, fold=False, null_keys=null_keys))


def missing_pairs(
    items: DataFrame, places: DataFrame, existing: DataFrame, item: str, place: str, block_rows: int = 1000
) -> DataFrame:
    """(item, place) pairs absent from ``existing``.

    The places are cut into blocks of about ``block_rows``; an item meets each block once, as an array, and
    keeps what it does not hold yet. Only missing pairs are ever emitted, and no array outgrows a block. Items are
    dealt evenly: each block is there once for every part of the items.
    """
    distinct_places = places.select(place).filter(F.col(place).isNotNull()).distinct()
    blocks = distinct_places.agg(
        F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / block_rows)).cast("int").alias("n")
    ).scalar()

    def block(df: DataFrame) -> DataFrame:
        return df.withColumn("_block", F.pmod(F.xxhash64(F.col(place)), blocks).cast("int"))

    parts = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    offered = block(distinct_places).groupBy("_block").agg(F.collect_list(place).alias("_offered"))
    offered = offered.withColumn("_part", every_part)
    held = (
        block(in_set(existing.select(item, place), distinct_places, place))
        .groupBy(item, "_block")
        .agg(F.collect_set(place).alias("_held"))
    )
    asked = items.select(item).distinct().withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    asked = asked.withColumn("_part", F.pmod(F.xxhash64(item), F.lit(parts)).cast("int"))
    open_places = F.when(F.col("_held").isNull(), F.col("_offered")).otherwise(F.array_except("_offered", "_held"))
    return (
        asked.join(offered, ["_block", "_part"])
        .join(held, [item, "_block"], "left")
        .select(item, F.explode(open_places).alias(place))
    )


def update_matched(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """Overwrite ``columns`` of the rows whose key is in ``changes``, NULLs included.

    Of several change rows for a key the first in ``order`` counts; without an order they fail the job.
    """
    if order is not None:
        changes = latest_per_key(changes, keys, order)
    else:
        repeated = F.raise_error(F.concat(F.lit("several changes for the key "), F.to_json(F.struct(*keys))))
        once = F.when(F.count(F.lit(1)) == 1, F.first(F.struct(*columns))).otherwise(repeated)
        changes = changes.groupBy(*keys).agg(once.alias("_change")).select(*keys, "_change.*")
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(new, list(keys), "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def apply_field_changes(
    target: DataFrame, changes: DataFrame, key: str, allowed: Mapping[str, str], sequence: str
) -> DataFrame:
    """Apply change rows ``(key, column_name, new_value, sequence)``; per field the highest sequence wins.

    ``allowed`` maps changeable columns to their types. A change of any other column, or text that does not
    fit the type, fails the job.
    """
    unknown = F.raise_error(F.concat(F.lit("column cannot be changed: "), F.col("column_name")))
    changes = changes.withColumn(
        "column_name", F.when(F.col("column_name").isin(*allowed), F.col("column_name")).otherwise(unknown)
    )

    def newest(column: str) -> Column:
        return F.max_by(F.struct("new_value"), F.when(F.col("column_name") == column, F.col(sequence)))

    per_key = changes.groupBy(key).agg(*[newest(c).alias(f"_change_{c}") for c in allowed])
    joined = target.join(per_key, key, "left")
    return joined.select(
        *[
            F.when(F.col(f"_change_{c}").isNotNull(), F.col(f"_change_{c}.new_value").cast(allowed[c]))
            .otherwise(F.col(c))
            .alias(c)
            if c in allowed
            else F.col(c)
            for c in target.columns
        ]
    )


def delete_keys(target: DataFrame, keys_to_drop: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot without the rows whose key is listed; rows with a NULL key stay."""
    return not_in_set(target, keys_to_drop, list(keys))


def highest_key(existing: DataFrame, key: str) -> Column:
    """The highest surrogate key of a table as a value, 0 if there is none."""
    return existing.agg(F.coalesce(F.max(key).cast("bigint"), F.lit(0).cast("bigint")).alias("m")).scalar()


def assign_keys(
    existing: DataFrame,
    batch: DataFrame,
    key: str,
    order: Sequence[Column],
    highest: Column | None = None,
    grouped: bool = False,
) -> DataFrame:
    """Give each row of ``batch`` the next surrogate keys after the highest one in ``existing``.

    ``highest`` is that key where the caller knows it. Rows equal in ``order`` follow their other columns, so the keys
    depend on values only and every job derived from the result sees the same ones. With ``grouped`` the first column
    of ``order`` has far fewer values than rows (see ``number_rows_by``).
    """
    highest = highest_key(existing, key) if highest is None else highest
    by = [By.of(item) for item in order]
    others = [f.name for f in batch.schema if f.name not in {b.column for b in by} and f.dataType.typeName() != "map"]
    if grouped:
        numbered = number_rows_by(batch, by[0].column, [*by[1:], *others], "_number")
    else:
        numbered = number_rows(batch, [*by, *others], "_number")
    return numbered.withColumn(key, F.col("_number") + highest).drop("_number")


def new_headers(
    headers: DataFrame,
    candidates: DataFrame,
    natural_key: Sequence[str],
    header_key: str,
    order: Sequence[Column],
    highest: Column | None = None,
) -> DataFrame:
    """New header rows with fresh keys: candidates not yet in ``headers`` by natural key.

    Join the result to a price or line table to derive the detail rows under the new keys.
    """
    fresh = not_in_set(candidates, headers, list(natural_key))
    only_keys = set(candidates.columns) == set(natural_key)
    once = fresh.distinct() if only_keys else latest_per_key(fresh, natural_key, order)
    return assign_keys(headers, once, header_key, order, highest)


def load_batch(
    existing: DataFrame,
    batch: DataFrame,
    natural_key: Sequence[str],
    key: str | None,
    order: Sequence[Column],
    lookups: Mapping[str, tuple[DataFrame, str, str, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows to append to a table, and the rejects: the usual load of a batch written with natural keys.

    Natural keys of other tables are resolved (see ``resolve_keys``), rows already there are skipped, the
    rest get the next surrogate keys (``key`` None: the table has none) and the columns of ``existing``;
    columns the batch lacks are NULL. ``natural_key`` is compared without case where it is text; a row with a
    NULL part of it is a reject.
    """
    resolved = resolve_keys(batch, lookups or {})
    missing = functools.reduce(lambda a, b: a | b, [F.col(c).isNull() for c in natural_key])
    unknown = F.when(missing, F.lit("natural key is NULL"))
    accepted, rejects = split_rejects(resolved.withColumn("reject_reason", F.coalesce("reject_reason", unknown)))
    fresh = rows_to_append(existing, accepted, natural_key, order)
    keyed = assign_keys(existing, fresh, key, order) if key else fresh
    types = dict(existing.dtypes)
    columns = [
        (F.col(c) if c in keyed.columns else F.lit(None)).cast(types[c]).alias(c) for c in existing.columns
    ]
    return keyed.select(*columns), rejects


def with_audit_column(df: DataFrame, as_of: Column, column: str = "record_ts") -> DataFrame:
    """Add an audit column with a default; a column that is there already keeps its values."""
    if column in df.columns:
        return df.withColumn(column, F.coalesce(F.col(column), as_of))
    return df.withColumn(column, as_of)
