"""The order job as a set of lazy reports.

Steps of the job: count the input, impute missing ratings with the rounded
mean, summarize by category, summarize express orders by region.  Here each
report is a separate lazy DataFrame; the mean is a scalar subquery inside
them, so no value passes through the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlens import constants as C
from ledgerlens.operators.clean import impute_mean
from ledgerlens.operators.summaries import category_summary, express_by_region, row_count


@dataclass(frozen=True)
class OrderReports:
    row_count: DataFrame
    category_summary: DataFrame
    express_by_region: DataFrame


def base_reports(
    df: DataFrame,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    rating: str = "customer_rating",
) -> OrderReports:
    imputed = impute_mean(df, rating)
    return OrderReports(
        row_count=row_count(df),
        category_summary=category_summary(imputed),
        express_by_region=express_by_region(imputed, threshold),
    )
