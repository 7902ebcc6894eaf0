"""What the operators of this folder share: written intermediate tables, literal arrays, source for the workers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or what the context was given, e.g. by tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors can reach")
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cut lineage that outlives executors.

    The files belong to the cluster's clean-up of its checkpoint folder: results are lazy, so the library cannot
    know when the last reader is done.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _free() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work`` of ``mapInArrow``; at the end of a task its memory goes back to the system.

    Spark keeps Python workers for later tasks. What they hold meanwhile counts for their executor, also while stages
    run that need none of them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _free()

    return functools.update_wrapper(run, work)


def lean_groups(work: Callable):
    """The same for ``work`` of groups, after each."""

    def run(rows):
        try:
            return work(rows)
        finally:
            _free()

    return run


def fresh_name(use: str) -> str:
    """A column name that no table has, in any case."""
    return f"{use}_{uuid.uuid4().hex}"


def literal_doubles(values: list[float]) -> Column:
    """An array<double> literal, which the optimizer folds to a constant."""
    return F.from_json(F.lit("[" + ",".join(repr(float(v)) for v in values) + "]"), "array<double>")


def parts_for(df: DataFrame, least: int = 1) -> int:
    """Number of shuffle partitions the session asks for; the cluster sizes it to its input."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@functools.cache
def _shipped(application_id: str) -> None:
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="salesloom-source-")
    archive = shutil.make_archive(f"{folder}/salesloom-source", "zip", package.parent, package.name)
    SparkContext.getOrCreate().addPyFile(archive)


#: Rows of an Arrow batch: texts and shingle sets are large, and the JVM keeps the memory of its largest batches.
BATCH_ROWS = 1000
_ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> SparkSession:
    """Hand the library's source to the Python workers, once per application; Spark copies it to the executors.

    Arrow batches are made smaller unless the session already asks for less than Spark's default.
    """
    _shipped(spark.sparkContext.applicationId)
    if int(spark.conf.get(_ROWS_SETTING, "10000")) >= 10_000:
        spark.conf.set(_ROWS_SETTING, str(BATCH_ROWS))
    return spark
