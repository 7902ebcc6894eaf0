"""Small literal relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _single(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def _constant(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def literal_rows(spark: SparkSession, schema: str, rows: Sequence[tuple]) -> DataFrame:
    """Rows written in the program, with a declared schema; built from literals inside the plan."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(fields, row)])
        for row in rows
    ]
    return _single(spark).select(F.inline(F.array(*structs)))


def one_row(spark: SparkSession, values: Mapping[str, object]) -> DataFrame:
    """A single row of constants; values may be Python values or column expressions."""
    return _single(spark).select(*[_constant(value).alias(name) for name, value in values.items()])


def with_fallback_row(result: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """``result``, or one row of constants when ``result`` is empty; one lazy plan, no action."""
    types = dict(result.dtypes)
    casted = {name: _constant(value).cast(types[name]) for name, value in values.items()}
    row = one_row(result.sparkSession, casted).filter(~result.select(F.lit(1)).exists())
    return result.unionByName(row)
