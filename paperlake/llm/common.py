"""What the operators of this folder share: tables by name, written tables and their size, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import connected, drop, forest, save, shared_dir, small_enough

__all__ = ["bits", "connected", "drop", "finish", "forest", "lean", "read", "save", "settle", "shared_dir", "small_enough", "trim"]

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bits(column, n: int):
    """The first n (<= 60) bits of a column's md5 as a long; null counts as a value of its own."""
    text = F.coalesce(F.concat(F.lit("v"), column.cast("string")), F.lit("n"))
    return F.shiftright(F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"), 60 - n)


def trim() -> None:
    """Gives memory that nothing uses back to the system. Workers are reused: what one step's large arrays have left in
    the allocators would stand beside the next step's for as long as the executor lives."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if release:
        release(0)


def lean(run: Run) -> Run:
    """A step for mapInArrow that leaves no memory behind."""

    @wraps(run)
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        trim()

    return step


def settle(spark: SparkSession) -> None:
    """Has the driver collect what no step refers to any more. Spark's cleaner then removes shuffle files and broadcasts of
    steps that are over, which else stay until the driver happens to collect, and the driver's memory shrinks."""
    trim()
    spark.sparkContext._jvm.System.gc()


def finish(*saved: DataFrame) -> None:
    """Remove tables written by save() once nothing reads them any more, and what is left of the steps between."""
    drop(*saved)
    settle(saved[0].sparkSession)
