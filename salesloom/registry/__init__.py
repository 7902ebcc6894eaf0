"""Registered queries: each is a library job applied to the test tables, next to the SQL it must equal."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesloom.sources.tables import Tables

_MODULES = ("sales", "rental", "gaps", "orders", "changes", "quality", "ordered")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None):
    """Register ``job(tables)`` under ``name`` together with the SQL that gives the same rows."""

    def register(job: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: job(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return job

    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"salesloom.registry.{module}")
