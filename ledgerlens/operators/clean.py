"""Missing-value handling: mean imputation and constant fill."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.functions.money import MEAN_SCALE, exact_mean, round_half_even

_FLOATING = (T.DoubleType, T.FloatType)
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _data_type(df: DataFrame, name: str) -> T.DataType:
    # select() resolves the name, so a missing column raises AnalysisException.
    return df.select(name).schema.fields[0].dataType


def missing_as_null(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null (NaN counts as missing)."""
    c = F.col(name)
    if isinstance(_data_type(df, name), _FLOATING):
        return F.nanvl(c, F.lit(None).cast("double"))
    return c


def mean_value(df: DataFrame, name: str, scale: int = C.IMPUTE_SCALE) -> DataFrame:
    """One-row frame: mean of the non-missing values, rounded to ``scale`` decimals
    half-even on the binary value.

    One global aggregate: partial sums per task, one tiny merge.  The sums neither
    overflow nor depend on the partitioning (``functions.money``).
    """
    units = 0 if isinstance(_data_type(df, name), _INTEGRAL) else MEAN_SCALE
    mean = df.agg(exact_mean(name, units, whole=units == 0).alias("mean"))
    return mean.select(round_half_even(F.col("mean"), scale).alias("fill_value"))


def impute_mean(df: DataFrame, name: str, scale: int = C.IMPUTE_SCALE) -> DataFrame:
    """Replace null and NaN in ``name`` by its rounded mean.

    The mean is a scalar subquery: Spark runs the one-row aggregate once
    (partial aggregates per task, one tiny final merge) and feeds the value into
    the projection, so the main scan stays one codegen'd stage with no join and
    nothing passes through Python.  With no values the column stays null.

    Present values keep their digits: a decimal column becomes wide enough for the
    fill's decimals, and so does a bigint column (as a decimal, since a double would
    round values past 2^53).  Smaller integers and floats become double.
    """
    fill = mean_value(df, name, scale).scalar()
    value, kind = missing_as_null(df, name), _data_type(df, name)
    if isinstance(kind, T.LongType):
        kind = T.DecimalType(19, 0)
    if isinstance(kind, T.DecimalType):
        digits = min(max(scale, kind.scale, 0), 38 - (kind.precision - kind.scale))
        target = T.DecimalType(kind.precision - kind.scale + digits, digits)
    else:
        target = T.DoubleType()
    return df.withColumn(name, F.coalesce(value.cast(target), fill.cast(target)))


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls (and NaN in floating columns) with a constant per column.

    A non-integral number filled into an integer column turns the column into
    double instead of truncating the value.
    """
    replaced = {}
    for name, value in values.items():
        target = _data_type(df, name)
        if isinstance(target, _INTEGRAL) and isinstance(value, float) and not value.is_integer():
            target = T.DoubleType()
        col = missing_as_null(df, name).cast(target)
        replaced[name] = F.coalesce(col, F.lit(value).cast(target))
    return df.withColumns(replaced)
