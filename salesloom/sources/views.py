"""Reports as named views, for users who query in SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def create_views(views: Mapping[str, DataFrame]) -> None:
    """Create or replace session views; a view keeps its plan, so it reads the tables when queried."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def drop_views(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
