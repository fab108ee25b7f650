"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.shared import shared_dir, shared_path

__all__ = ["LOWER", "UPPER", "ascii_lower", "give_back", "in_arrow", "materialise", "remove_path", "shared_dir", "shared_path", "shuffle_width", "small_batches", "table", "then_rest"]

#: Rows that travel to a Python worker at a time.
ARROW_ROWS = 4000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def materialise(df: DataFrame) -> DataFrame:
    """Cuts lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a table below the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


_given = [0.0]


def give_back(least_seconds: float = 0.0) -> None:
    """Hands memory that a process has freed back to the system: Python workers live on, beside other work. Not again within ``least_seconds``."""
    if time.monotonic() - _given[0] < least_seconds:
        return
    _given[0] = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def then_rest(work: Callable) -> Callable:
    """A function of one or two grouped tables that gives memory back after groups, about once a second."""

    def one(table):
        out = work(table)
        give_back(1.0)
        return out

    def two(left, right):
        out = work(left, right)
        give_back(1.0)
        return out

    return two if work.__code__.co_argcount == 2 else one


def small_batches(spark: SparkSession, most: int = ARROW_ROWS) -> None:
    """Lets at most so many rows of the session travel to Python at a time: they hold whole texts, of any length."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= most:
        spark.conf.set(key, str(most))


def in_arrow(rows: DataFrame, work: Callable, schema: str, most: int = ARROW_ROWS) -> DataFrame:
    """``mapInArrow`` in small batches, by workers that give memory back at the end of each task."""

    def run(batches):
        yield from work(batches)
        give_back()

    small_batches(rows.sparkSession, most)
    return rows.mapInArrow(run, schema)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
