"""Row filters of the order job.  Catalyst merges them into one predicate and
pushes it into the Parquet scan (row-group skipping on min/max statistics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C


def filter_flag(df: DataFrame, flag: str = "is_express") -> DataFrame:
    """Keep rows whose boolean flag is true; a null flag drops the row."""
    return df.filter(F.col(flag))


def filter_amount_gt(
    df: DataFrame, threshold: float = C.EXPRESS_AMOUNT_THRESHOLD, amount: str = "total_amount"
) -> DataFrame:
    """Keep rows with ``amount > threshold`` (strict)."""
    return df.filter(F.col(amount) > F.lit(threshold))


def filter_express_amount(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    flag: str = "is_express",
    amount: str = "total_amount",
) -> DataFrame:
    """Express orders above the amount threshold (conjunction of both filters)."""
    return df.filter(F.col(flag) & (F.col(amount) > F.lit(threshold)))
