import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import clean, filters, summaries
from ledgerlens.sources import tables

from .conftest import SF01

# Golden rows at sf0.01 (FIXTURES.md section 3).
GOLDEN_CATEGORY = [
    ("RF", 10009, 534508020.74, 2.993406, 25.376561),
    ("AO", 10025, 533532621.08, 2.983521, 25.205486),
    ("NO", 10002, 532475458.02, 3.003359, 25.445311),
    ("RO", 10037, 531333902.39, 3.007213, 25.360964),
    ("AF", 10003, 527868276.59, 3.005918, 25.386584),
    ("NF", 9924, 523537992.81, 2.991576, 25.641072),
]
GOLDEN_EXPRESS = [
    ("R4", 2197, 150798125.45),
    ("R0", 2161, 146549989.97),
    ("R2", 2135, 145050106.44),
    ("R3", 2159, 144364472.47),
    ("R1", 2105, 142447494.72),
]


def _orders(spark, rows):
    return spark.createDataFrame(
        rows,
        "order_id string, product_category string, quantity int, delivery_region string, "
        "is_express boolean, customer_rating double, total_amount double",
    )


def test_category_summary_golden(spark):
    imputed = clean.impute_mean(tables.order_lines(spark, SF01), "customer_rating")
    got = [tuple(r) for r in summaries.category_summary(imputed).collect()]
    assert got == GOLDEN_CATEGORY


def test_express_by_region_golden(spark):
    got = [tuple(r) for r in summaries.express_by_region(tables.order_lines(spark, SF01), 30000.0).collect()]
    assert got == GOLDEN_EXPRESS


def test_order_line_fixture_facts(spark):
    ol = tables.order_lines(spark, SF01)
    row = ol.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("customer_rating").isNull()).alias("nulls"),
        F.round(F.avg("customer_rating"), 6).alias("mean"),
    ).first()
    assert (row.n, row.nulls, row.mean) == (60000, 3036, 2.997374)


def test_null_flag_is_dropped_and_threshold_is_strict(spark):
    df = _orders(spark, [
        ("a", "X", 1, "R", None, 1.0, 500.0),
        ("b", "X", 1, "R", True, 1.0, 100.0),
        ("c", "X", 1, "R", True, 1.0, 100.01),
    ])
    assert [r.order_id for r in filters.filter_express_amount(df, 100.0).collect()] == ["c"]


def test_null_group_key_is_its_own_group_and_ties_order_by_key(spark):
    df = _orders(spark, [
        ("a", None, 1, "R", True, 1.0, 10.0),
        ("b", "B", 1, "R", True, 1.0, 10.0),
        ("c", "A", 1, "R", True, 1.0, 10.0),
        ("d", "C", 1, "R", True, None, 5.0),
    ])
    got = [(r.product_category, r.revenue) for r in summaries.category_summary(df).collect()]
    assert got == [("A", 10.0), ("B", 10.0), (None, 10.0), ("C", 5.0)]


def test_count_skips_nulls(spark):
    df = _orders(spark, [("a", "X", 1, "R", True, None, 1.0), ("b", "X", 1, "R", True, 2.0, 1.0)])
    row = summaries.count_non_null_by(df, "product_category", "customer_rating", "n").first()
    assert row.n == 1


def test_money_sum_is_exact_in_cents(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)] * 1000, "total_amount double")
    assert summaries.row_count(df).first().row_count == 3000
    got = df.agg(summaries.money_sum("total_amount").alias("s")).first().s
    assert got == 600.0


def test_top_n_plans_as_take_ordered(spark):
    imputed = clean.impute_mean(tables.order_lines(spark, SF01), "customer_rating")
    plan = summaries.top_n(summaries.category_summary(imputed), 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_filters_reach_the_parquet_scan(spark):
    df = summaries.express_by_region(tables.order_lines(spark, SF01), 30000.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_extendedprice,30000.0)" in plan
    # Only the three lineitem columns the report needs are read.
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_extendedprice:double>" in plan


def test_money_sum_skips_nan_and_null(spark):
    df = spark.createDataFrame([(1.25,), (None,), (float("nan"),), (2.5,)], "total_amount double")
    assert df.agg(summaries.money_sum("total_amount").alias("s")).first().s == 3.75
    empty = spark.createDataFrame([(None,)], "total_amount double")
    assert empty.agg(summaries.money_sum("total_amount").alias("s")).first().s is None


# FIXTURES.md section 3: rows, null ratings, mean, fill, express > 100, express > 30000.
FIXTURE_FACTS = {
    "/root/testdata/sf0.001": (6000, 284, 3.008048, 3.0, 1533, 1089),
    "/root/testdata/sf0.01": (60000, 3036, 2.997374, 3.0, 14974, 10757),
    "/root/testdata/sf0.1": (600000, 29782, 2.998484, 3.0, 150134, 108239),
}


@pytest.mark.parametrize("sf_dir", sorted(FIXTURE_FACTS))
def test_order_line_facts_at_every_scale(spark, sf_dir):
    ol = tables.order_lines(spark, sf_dir)
    row = ol.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("customer_rating").isNull()).alias("nulls"),
        F.round(F.avg("customer_rating"), 6).alias("mean"),
    ).first()
    fill = clean.mean_value(ol, "customer_rating").first().fill_value
    x100 = filters.filter_express_amount(ol, 100.0).count()
    x30k = filters.filter_express_amount(ol, 30000.0).count()
    assert (row.n, row.nulls, row.mean, fill, x100, x30k) == FIXTURE_FACTS[sf_dir]


def test_integer_means_use_whole_units_and_do_not_overflow(spark):
    from ledgerlens.operators.summaries import unit_scale
    df = spark.createDataFrame([("k", 10**15), ("k", 10**15 + 2)], "g string, v bigint")
    assert unit_scale(df, "v") == 0
    assert unit_scale(spark.createDataFrame([(1.5,)], "x double"), "x") == 6
    assert summaries.avg_by(df, "g", "v", "m").first().m == float(10**15 + 1)
    assert clean.mean_value(df, "v", 0).first().fill_value == float(10**15 + 1)
