"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the
    lineage, survives lost executors and is computed once."""
    path = scratch_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run: Callable) -> Callable:
    """The map ``run`` over Arrow batches; at its end the task gives freed memory back to
    the system, which a reused Python worker would else hold through later stages."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)
    return mapped


def hash_fraction(col: str, seed: int):
    """A uniform number in [0, 1) that depends on the value alone, not on partitions."""
    return F.pmod(F.xxhash64(F.col(col), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
