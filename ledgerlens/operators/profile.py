"""Table profile: shape, column types, missing values per column, first rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATING = (T.DoubleType, T.FloatType)


def profile_shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and number of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("int")
    )


def profile_dtypes(spark: SparkSession, df: DataFrame) -> DataFrame:
    """One row per column: position, name and Spark SQL type (schema metadata)."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def _missing(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, _FLOATING):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def profile_null_counts(df: DataFrame) -> DataFrame:
    """Missing values (null, and NaN in floating columns) per column.

    All columns are counted in one aggregate over one scan; the single result
    row is then turned into one row per column.
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(_missing(f)).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.col(f"c{i}").alias("null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(entries))


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark SQL type and non-missing values.

    Like a pandas ``info()`` listing: the types come from the schema, the
    counts from one aggregate over the data (null, and NaN in floating
    columns, count as missing).
    """
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(~_missing(f)).alias(f"c{i}") for i, f in enumerate(fields)])
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("non_null_count"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(entries))


def profile_head(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a key is required: files have no row order).

    The remaining sortable columns break ties, so a non-unique key still gives
    the same rows on every run.  Plans as ``TakeOrderedAndProject``: a per-task
    top n, not a global sort.
    """
    if not order_by:
        raise ValueError("profile_head needs an ordering key")
    named = {c for c in order_by if isinstance(c, str)}
    ties = [F.col(f"`{f.name}`") for f in df.schema.fields
            if f.name not in named and not isinstance(f.dataType, T.MapType)]
    return df.orderBy(*order_by, *ties).limit(n)


def file_head(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of files in the order they are stored: by file path, then by the
    split's place in the file, then by the row's place in the split.

    ``df`` is a file scan (or columns and filters over one).  Any split size gives the same
    rows, and it is a top n per task, not a global sort.
    """
    place = {"_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start"),
             "_row": F.monotonically_increasing_id()}
    # by position: the frame's own columns may have these names
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_kept"), *(c.alias(name) for name, c in place.items()))
    return rows.orderBy(*place).limit(n).select("_kept.*")
