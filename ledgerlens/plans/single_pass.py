"""Single-pass order job: one scan, one small shuffle for all reports.

The base job reads its input three times: the rating mean, the category
report and the express report.  Everything the reports need is decomposable:
counts and the parts of the sums (``functions.money``).  So one ``groupBy(category, region)``
collects per-group statistics, with partial aggregation inside the scan stage.
The mean, the imputed average rating and both reports are then derived from
that statistics table, whose size is bounded by the number of
(category, region) pairs and not by the input.

Imputed average rating of a group:
(sum of present ratings + fill * missing ratings) / rows, where fill is the
rounded global mean; with no rating at all the fill and the average stay null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.functions.money import MEAN_SCALE, parts, round_half_even, stored_parts, total
from ledgerlens.operators.clean import missing_as_null
from ledgerlens.operators.summaries import AVG_SCALE, ranked, unit_scale
from ledgerlens.session import checkpoint_root


def order_stats(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    category: str = "product_category",
    region: str = "delivery_region",
    scale: int = 2,
) -> DataFrame:
    """Per (category, region): everything both reports and the mean need."""
    rating = missing_as_null(df, "customer_rating")
    express = F.col("is_express") & (F.col("total_amount") > F.lit(threshold))
    amount = parts("total_amount", scale)
    quantity = parts("quantity", unit_scale(df, "quantity"), whole=unit_scale(df, "quantity") == 0)
    return df.groupBy(category, region).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("order_id").alias("n_orders"),
        *amount.map(F.sum).columns("amount"),
        F.count(rating).alias("n_rated"),
        *parts("customer_rating", MEAN_SCALE).map(F.sum).columns("rating"),
        *quantity.map(F.sum).columns("qty"),
        F.count(quantity.rest).alias("n_qty"),
        F.count_if(express).alias("x_rows"),
        F.count(F.when(express, F.col("order_id"))).alias("x_orders"),
        *amount.map(lambda c: F.sum(F.when(express, c))).columns("express"),
    )


def fill_value(stats: DataFrame, scale: int = C.IMPUTE_SCALE) -> DataFrame:
    """One-row frame: the rounded mean rating, from the statistics table; the same
    arithmetic as ``clean.mean_value``, so both plans impute the same value."""
    mean = total(stored_parts("rating").map(F.sum), MEAN_SCALE, F.sum("n_rated"))
    return stats.agg(mean.alias("mean")).select(round_half_even(F.col("mean"), scale).alias("fill_value"))


def reports_from_stats(
    stats: DataFrame,
    category: str = "product_category",
    region: str = "delivery_region",
    scale: int = C.IMPUTE_SCALE,
    avg_scale: int = AVG_SCALE,
    amount_scale: int = 2,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row count, category summary, express by region) from ``order_stats``."""
    fill = fill_value(stats, scale).scalar()
    whole = "qty_d3" not in stats.columns  # whole numbers have fewer digits
    quantity = stored_parts("qty", whole)
    by_cat = stats.groupBy(category).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_orders").alias("total_orders"),
        F.sum("n_rated").alias("n_rated"),
        F.sum("n_qty").alias("n_qty"),
        *(c for name, p in (("amount", stored_parts("amount")), ("rating", stored_parts("rating")), ("qty", quantity))
          for c in p.map(F.sum).columns(name)),
    )
    # The imputed rows add the parts of the fill, once for each missing rating.  Values
    # that several expressions read are columns first, so the plan holds each once.
    by_cat = by_cat.withColumn("fill", fill).withColumn("missing", F.col("n_rows") - F.col("n_rated"))
    by_cat = by_cat.select("*", *parts("fill", MEAN_SCALE).columns("fill"))

    def joined(have: Column, more: Column) -> Column:
        filled = more * F.col("missing")
        return F.coalesce(have + filled, have, filled)

    imputed = stored_parts("rating").with_parts(stored_parts("fill"), joined)
    slots = F.col("n_rated") + F.when(F.col("fill").isNotNull(), F.col("missing")).otherwise(F.lit(0))
    by_cat = by_cat.select("*", *imputed.columns("imputed"), slots.alias("slots"))
    quantity = total(quantity, 0 if whole else MEAN_SCALE, F.col("n_qty"))
    summary = by_cat.select(
        category,
        "total_orders",
        total(stored_parts("amount"), amount_scale).alias("revenue"),
        F.round(total(stored_parts("imputed"), MEAN_SCALE, F.col("slots")), avg_scale).alias("avg_rating"),
        F.round(quantity, avg_scale).alias("avg_quantity"),
    )
    express = (
        stats.groupBy(region)
        .agg(
            F.sum("x_rows").alias("x_rows"),
            F.sum("x_orders").alias("express_orders"),
            total(stored_parts("express").map(F.sum), amount_scale).alias("express_revenue"),
        )
        .filter(F.col("x_rows") > 0)
        .drop("x_rows")
    )
    count = stats.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("row_count"))
    return count, ranked(summary, "revenue", category), ranked(express, "express_revenue", region)


def single_pass_reports(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    materialize: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All reports from one scan.

    With ``materialize`` the statistics table is checkpointed to the shared
    checkpoint folder (reliable, lineage cut) so the three reports read it
    instead of re-running the scan; it holds one row per (category, region).
    Without it every report scans the input once more.
    """
    stats = order_stats(df, threshold)
    if materialize:
        checkpoint_root(df.sparkSession)
        stats = stats.checkpoint(eager=True)
    return reports_from_stats(stats)
