"""Integrity report, null audit, declared schemas and row visibility."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesloom.operators.lookup import in_set


@dataclass(frozen=True)
class NotNull:
    table: str
    column: str


@dataclass(frozen=True)
class Check:
    """A condition in SQL syntax; a row breaks it only when it is FALSE (NULL passes)."""

    table: str
    name: str
    condition: str


@dataclass(frozen=True)
class Unique:
    """No two rows share the key; keys with a NULL part are not compared."""

    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """Every key without NULL parts occurs in the parent table."""

    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


Rule = NotNull | Check | Unique | ForeignKey


def rule_name(rule: Rule) -> str:
    match rule:
        case NotNull():
            return f"{rule.column} not null"
        case Check():
            return rule.name
        case Unique():
            return f"{', '.join(rule.columns)} unique"
        case ForeignKey():
            return f"{', '.join(rule.columns)} in {rule.parent}"


def _is_broken(rule: NotNull | Check) -> Column:
    if isinstance(rule, NotNull):
        return F.col(rule.column).isNull()
    return F.coalesce(~F.expr(rule.condition), F.lit(False))


def _key_text(key: Column, columns: Sequence[str]) -> Column:
    """A key (struct) as text; a NULL part shows as NULL."""
    parts = [F.coalesce(key[c].cast("string"), F.lit("NULL")) for c in columns]
    return F.when(key.isNotNull(), F.concat_ws("|", *parts))


def _complete(columns: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _report(rule: Rule, found: Column, first: Column, last: Column) -> Column:
    return F.struct(
        F.lit(rule.table).alias("table_name"),
        F.lit(rule_name(rule)).alias("rule"),
        F.coalesce(found, F.lit(0)).cast("bigint").alias("violations"),
        first.alias("first_key"),
        last.alias("last_key"),
    )


def _row_rules(df: DataFrame, rules: Sequence[NotNull | Check], key: Sequence[str]) -> DataFrame:
    """All row rules of a table in one scan: each is a counter with the lowest and highest offending key."""
    aggregates = []
    for i, rule in enumerate(rules):
        offender = F.when(_is_broken(rule), F.struct(*key))
        aggregates += [
            F.count_if(_is_broken(rule)).alias(f"n{i}"),
            F.min(offender).alias(f"lo{i}"),
            F.max(offender).alias(f"hi{i}"),
        ]
    counters = df.agg(*aggregates)
    rows = [
        _report(r, F.col(f"n{i}"), _key_text(F.col(f"lo{i}"), key), _key_text(F.col(f"hi{i}"), key))
        for i, r in enumerate(rules)
    ]
    return counters.select(F.inline(F.array(*rows)))


def _key_rules(
    table: DataFrame, rules: Sequence[Unique | ForeignKey], parents: Mapping[str, DataFrame]
) -> DataFrame:
    """All unique and foreign keys of a table in one pass: its rows become one row per key, parents add their keys with
    a bit that names the rule, and every key is counted once, in the map tasks first.

    A key has columns of its own, so it keeps its types; it is NULL in the rows of other keys.
    """
    tuples = list(dict.fromkeys(rule.columns for rule in rules))

    def slot(key: int, part: int) -> str:
        return f"k{key}_{part}"

    def entry(key: int, source: Sequence[str], copies: int, parent: int) -> Column:
        types = [(k, i, f.dataType) for k, columns in enumerate(tuples) for i, f in enumerate(table.select(*columns).schema)]
        values = [
            (F.col(source[i]) if k == key else F.lit(None).cast(kind)).alias(slot(k, i)) for k, i, kind in types
        ]
        marks = [F.lit(copies).cast("long").alias("copies"), F.lit(parent).cast("long").alias("parents")]
        return F.when(_complete(source), F.struct(F.lit(key).alias("key"), *values, *marks))

    own = [entry(k, columns, 1, 0) for k, columns in enumerate(tuples)]
    rows = table.select(F.inline(F.array(*own)))
    for bit, rule in enumerate(rules):
        if isinstance(rule, ForeignKey):
            one = entry(tuples.index(rule.columns), rule.parent_columns, 0, 1 << bit)
            rows = rows.unionByName(parents[rule.parent].select(F.inline(F.array(one))))
    slots = [slot(k, i) for k, columns in enumerate(tuples) for i in range(len(columns))]
    counted = rows.filter(F.col("key").isNotNull()).groupBy("key", *slots)
    counted = counted.agg(F.sum("copies").alias("copies"), F.bit_or("parents").alias("parents"))

    aggregates, reports = [], []
    for bit, rule in enumerate(rules):
        key = tuples.index(rule.columns)
        if isinstance(rule, Unique):
            broken, count = F.col("copies") > 1, F.lit(1)
        else:
            broken, count = (F.col("copies") > 0) & (F.col("parents").bitwiseAND(F.lit(1 << bit)) == 0), F.col("copies")
        broken &= F.col("key") == key
        offender = F.when(broken, F.struct(*[F.col(slot(key, i)).alias(c) for i, c in enumerate(rule.columns)]))
        aggregates += [
            F.sum(F.when(broken, count)).alias(f"n{bit}"),
            F.min(offender).alias(f"lo{bit}"),
            F.max(offender).alias(f"hi{bit}"),
        ]
        first, last = (_key_text(F.col(f"{c}{bit}"), rule.columns) for c in ("lo", "hi"))
        reports.append(_report(rule, F.col(f"n{bit}"), first, last))
    return counted.agg(*aggregates).select(F.inline(F.array(*reports)))


def integrity_report(
    tables: Mapping[str, DataFrame], rules: Sequence[Rule], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """One row per rule: table, rule, number of violations, lowest and highest offending key.

    Row rules count rows, unique rules count repeated keys, foreign keys count orphan rows. ``keys`` names
    the identifying columns of each table. A table is read at most twice for its own rules, and once for every foreign
    key that refers to it.
    """
    parts = []
    for table in dict.fromkeys(rule.table for rule in rules):
        own = [r for r in rules if r.table == table]
        per_row = [r for r in own if isinstance(r, NotNull | Check)]
        if per_row:
            parts.append(_row_rules(tables[table], per_row, keys[table]))
        on_keys = [r for r in own if isinstance(r, Unique | ForeignKey)]
        if on_keys:
            parts.append(_key_rules(tables[table], on_keys, tables))
    return functools.reduce(DataFrame.unionByName, parts)


def null_audit(tables: Mapping[str, DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column (or of the listed ones) of every table; one aggregate per table."""
    parts = []
    for name, df in tables.items():
        audited = [c for c in df.columns if columns is None or c in columns]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in audited])
        parts.append(
            counts.unpivot([], audited, "column_name", "null_count").select(
                F.lit(name).alias("table_name"), "column_name", "null_count"
            )
        )
    return functools.reduce(DataFrame.unionByName, parts)


def schema_drift(df: DataFrame, declared: T.StructType) -> list[tuple[str, str]]:
    """Differences between a DataFrame's schema and the declared one: (column, problem). Reads no data."""
    actual = {f.name: f.dataType for f in df.schema}
    wanted = {f.name: f.dataType for f in declared}
    problems = [(c, "missing") for c in wanted if c not in actual]
    problems += [(c, "not declared") for c in actual if c not in wanted]
    problems += [
        (c, f"{actual[c].simpleString()} instead of {t.simpleString()}")
        for c, t in wanted.items()
        if c in actual and actual[c] != t
    ]
    return problems


def conform(
    df: DataFrame, declared: T.StructType, defaults: Mapping[str, object] | None = None, failures: str | None = None
) -> DataFrame:
    """Cast to the declared types and column order; a missing column is its default or NULL.

    A value that does not fit becomes NULL, and a NULL stays NULL, whatever the default. ``failures`` names a
    column that lists the columns in which a value was lost.
    """
    defaults = defaults or {}
    present = set(df.columns)
    columns, lost = [], []
    for field in declared:
        if field.name in present:
            raw = F.col(field.name)
            value = raw.try_cast(field.dataType)
            lost.append(F.when(raw.isNotNull() & value.isNull(), F.lit(field.name)))
        else:
            value = F.lit(defaults.get(field.name)).cast(field.dataType)
        columns.append(value.alias(field.name))
    if failures:
        columns.append(F.concat_ws(",", *lost).alias(failures))
    return df.select(*columns)


def visible_rows(df: DataFrame, entitlements: DataFrame, principal: str, key: str) -> DataFrame:
    """Rows a principal may see: those whose key is granted to it. No grant, no rows."""
    return in_set(df, entitlements.filter(F.col("principal") == principal), key)


def grants_by_name(principals: DataFrame, people: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """Grants (principal, key) for principals known by name: of several people with one name the lowest key.

    A principal whose name is not found gets no grant.
    """
    lowest = people.groupBy(*names).agg(F.min(key).alias(key))
    return principals.join(lowest, list(names)).select("principal", key)


def rows_by_principal(df: DataFrame, entitlements: DataFrame, key: str) -> DataFrame:
    """Every principal's view of the table at once: one row per (principal, visible row)."""
    return df.join(entitlements.select("principal", key).distinct(), key)
