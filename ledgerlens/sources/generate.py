"""Synthetic order lines generated on Spark.

Every column is a pure function of the row id and the seed (hash uniforms,
``ledgerlens.functions.random``), so the table is identical for any number of
partitions or executors and is produced without a shuffle.  The distributions
are the job's: uniform day/hour of 2024, weighted categories and regions,
uniform quantity, lognormal price, Bernoulli express flag, clipped normal
rating with about 5 % missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions.random import (
    hash_uniform,
    lognormal,
    standard_normal,
    uniform_int,
    weighted_choice,
)
from ledgerlens.session import default_parallelism

# Variate -> (digest salt, 32-bit slot): four independent uniforms per digest,
# three digests per row.
VARIATES = {
    "day": ("a", 0), "hour": ("a", 1), "cat": ("a", 2), "qty": ("a", 3),
    "p1": ("b", 0), "p2": ("b", 1), "reg": ("b", 2), "ex": ("b", 3),
    "r1": ("c", 0), "r2": ("c", 1), "nul": ("c", 2),
}


# Rows per generated partition when none is given: about 100-150 MB of order
# lines per task, whatever the table size.
ROWS_PER_PARTITION = 2_000_000


def order_ids(spark: SparkSession, n_rows: int, num_partitions: int | None = None) -> DataFrame:
    """Ids 1..n as column ``id``, split evenly over ``num_partitions``.

    By default the partition count grows with ``n_rows`` (``ROWS_PER_PARTITION``
    each, at least the cluster's default parallelism), so a 10^12-row table
    is not cut into a few huge tasks.
    """
    if num_partitions is None:
        num_partitions = max(default_parallelism(spark), -(-n_rows // ROWS_PER_PARTITION))
    return spark.range(1, n_rows + 1, numPartitions=num_partitions)


def _u(id_col: str, variate: str, seed: int) -> Column:
    salt, slot = VARIATES[variate]
    return hash_uniform(id_col, salt, seed, slot)


def order_id(id_col: str = "id") -> Column:
    return F.format_string("ORD-%07d", F.col(id_col))


def order_date(id_col: str = "id", seed: int = C.GEN_SEED) -> Column:
    days = F.floor(_u(id_col, "day", seed) * float(C.GEN_DAYS)).cast("int")
    hours = F.floor(_u(id_col, "hour", seed) * float(C.GEN_HOURS)).cast("int")
    base = F.lit(C.GEN_BASE_DATE).cast("timestamp_ntz")
    return base + F.make_dt_interval(days=days, hours=hours)


def product_category(id_col: str = "id", seed: int = C.GEN_SEED, weights=None) -> Column:
    return weighted_choice(_u(id_col, "cat", seed), C.GEN_CATEGORIES, weights or C.GEN_CATEGORY_WEIGHTS)


def quantity(id_col: str = "id", seed: int = C.GEN_SEED) -> Column:
    return uniform_int(_u(id_col, "qty", seed), C.GEN_QUANTITY_LOW, C.GEN_QUANTITY_HIGH)


def unit_price(id_col: str = "id", seed: int = C.GEN_SEED) -> Column:
    price = lognormal(_u(id_col, "p1", seed), _u(id_col, "p2", seed), C.GEN_PRICE_MU, C.GEN_PRICE_SIGMA)
    return F.round(price, C.GEN_PRICE_SCALE)


def delivery_region(id_col: str = "id", seed: int = C.GEN_SEED, weights=None) -> Column:
    return weighted_choice(_u(id_col, "reg", seed), C.GEN_REGIONS, weights or C.GEN_REGION_WEIGHTS)


def is_express(id_col: str = "id", seed: int = C.GEN_SEED) -> Column:
    return _u(id_col, "ex", seed) < F.lit(C.GEN_EXPRESS_P)


def rating(id_col: str = "id", seed: int = C.GEN_SEED) -> Column:
    """Clipped normal rating, before missing values are injected."""
    z = standard_normal(_u(id_col, "r1", seed), _u(id_col, "r2", seed))
    raw = F.lit(C.GEN_RATING_MU) + F.lit(C.GEN_RATING_SIGMA) * z
    clipped = F.greatest(F.lit(C.GEN_RATING_MIN), F.least(F.lit(C.GEN_RATING_MAX), raw))
    return F.round(clipped, C.GEN_RATING_SCALE)


def with_missing(value: Column, id_col: str = "id", seed: int = C.GEN_SEED,
                 p: float = C.GEN_RATING_NULL_P) -> Column:
    """``value`` replaced by null with probability ``p``."""
    return F.when(_u(id_col, "nul", seed) >= F.lit(p), value)


def total_amount(qty: Column, price: Column) -> Column:
    """quantity * unit_price, unrounded like the source data."""
    return qty * price


def format_date(c: Column, fmt: str = C.GEN_DATE_FORMAT) -> Column:
    return F.date_format(c, fmt)


def order_table(
    ids: DataFrame, id_col: str = "id", seed: int = C.GEN_SEED,
    category_weights=None, region_weights=None,
) -> DataFrame:
    """Order lines for every id of ``ids`` (ids must be unique for unique orders).

    ``category_weights`` / ``region_weights`` replace the default mix, e.g. to
    make one category hold most rows when testing hot keys.
    """
    base = ids.select(
        order_id(id_col).alias("order_id"),
        order_date(id_col, seed).alias("order_date"),
        product_category(id_col, seed, category_weights).alias("product_category"),
        quantity(id_col, seed).alias("quantity"),
        unit_price(id_col, seed).alias("unit_price"),
        delivery_region(id_col, seed, region_weights).alias("delivery_region"),
        is_express(id_col, seed).alias("is_express"),
        with_missing(rating(id_col, seed), id_col, seed).alias("customer_rating"),
    )
    return base.select(
        "order_id", "order_date", "product_category", "quantity", "unit_price",
        "delivery_region", "is_express", "customer_rating",
        total_amount(F.col("quantity"), F.col("unit_price")).alias("total_amount"),
    )


def generate_orders(
    spark: SparkSession,
    n_rows: int = C.GEN_ROWS,
    seed: int = C.GEN_SEED,
    num_partitions: int | None = None,
    category_weights=None,
    region_weights=None,
) -> DataFrame:
    """The synthetic order-line table with ``n_rows`` rows."""
    return order_table(order_ids(spark, n_rows, num_partitions), "id", seed,
                       category_weights, region_weights)
