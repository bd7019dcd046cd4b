"""Grouped order summaries (the job's two reports) and their building blocks.

Each summary is one ``groupBy().agg()``: Spark computes partial aggregates
inside the scan stage, shuffles one small row per group and task, and merges.
Group keys with a third of all rows cost nothing extra, because only partial
aggregates cross the shuffle.  Sums neither overflow nor depend on the order of
the rows (``functions.money``); averages are rounded to ``avg_scale`` decimals.
``scale`` is the number of decimals that amounts are summed at exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens.functions.money import MEAN_SCALE, exact_mean, money_sum
from ledgerlens.operators.filters import filter_express_amount

AVG_SCALE = 6


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def unit_scale(df: DataFrame, name: str) -> int:
    """Units of a mean of ``name``: whole numbers for integer columns, else 10^-6."""
    dtype = df.select(name).schema.fields[0].dataType
    return 0 if isinstance(dtype, _INTEGRAL) else MEAN_SCALE


def rounded_avg(c: Column | str, scale: int = AVG_SCALE, units: int = MEAN_SCALE) -> Column:
    """Mean rounded to ``scale`` decimals, summed exactly in 10^-units steps
    (``exact_mean``), so every plan and partitioning gives the same digits."""
    return F.round(exact_mean(c, units, whole=units == 0), scale)


def row_count(df: DataFrame) -> DataFrame:
    """Global row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def mean_of(df: DataFrame, name: str, alias: str, scale: int = AVG_SCALE) -> DataFrame:
    """Global null-skipping mean; null on empty input."""
    return df.agg(rounded_avg(name, scale, unit_scale(df, name)).alias(alias))


def ranked(df: DataFrame, by: str, key: str) -> DataFrame:
    """Descending by ``by`` (nulls last) with the group key as tie-breaker."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(key).asc_nulls_last())


def category_summary(
    df: DataFrame,
    key: str = "product_category",
    order_id: str = "order_id",
    amount: str = "total_amount",
    rating: str = "customer_rating",
    quantity: str = "quantity",
    avg_scale: int = AVG_SCALE,
    scale: int = 2,
) -> DataFrame:
    """Orders, revenue, mean rating and mean quantity per category, by revenue."""
    out = df.groupBy(key).agg(
        F.count(order_id).alias("total_orders"),
        money_sum(amount, scale).alias("revenue"),
        rounded_avg(rating, avg_scale, unit_scale(df, rating)).alias("avg_rating"),
        rounded_avg(quantity, avg_scale, unit_scale(df, quantity)).alias("avg_quantity"),
    )
    return ranked(out, "revenue", key)


def express_by_region(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    key: str = "delivery_region",
    order_id: str = "order_id",
    flag: str = "is_express",
    amount: str = "total_amount",
    scale: int = 2,
) -> DataFrame:
    """Express orders above ``threshold``: count and revenue per region, by revenue."""
    out = (
        filter_express_amount(df, threshold, flag, amount)
        .groupBy(key)
        .agg(F.count(order_id).alias("express_orders"), money_sum(amount, scale).alias("express_revenue"))
    )
    return ranked(out, "express_revenue", key)


def count_non_null_by(df: DataFrame, key: str, name: str, alias: str) -> DataFrame:
    """``count(name)`` per group: null values are not counted."""
    return df.groupBy(key).agg(F.count(name).alias(alias))


def money_sum_by(df: DataFrame, key: str, amount: str, alias: str, scale: int = 2) -> DataFrame:
    return df.groupBy(key).agg(money_sum(amount, scale).alias(alias))


def avg_by(df: DataFrame, key: str, name: str, alias: str, scale: int = AVG_SCALE) -> DataFrame:
    return df.groupBy(key).agg(rounded_avg(name, scale, unit_scale(df, name)).alias(alias))


def top_n(df: DataFrame, n: int = C.SHOW_ROWS) -> DataFrame:
    """First ``n`` rows of an ordered frame.  Directly after ``orderBy`` this
    plans as ``TakeOrderedAndProject``: each task keeps its own top n and only
    n rows per task reach the final merge, instead of a full global sort."""
    return df.limit(n)
