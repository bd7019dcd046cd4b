import math

from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.sources.generate import generate_orders

N = 20_000


def _rows(spark, partitions):
    df = generate_orders(spark, N, seed=C.GEN_SEED, num_partitions=partitions)
    return sorted(tuple(r) for r in df.collect())


def test_same_rows_for_any_partitioning(spark):
    one = _rows(spark, 1)
    assert one == _rows(spark, 4)
    assert one == _rows(spark, 16)


def test_schema_and_ids(spark):
    df = generate_orders(spark, 10, num_partitions=2)
    assert df.columns == [
        "order_id", "order_date", "product_category", "quantity", "unit_price",
        "delivery_region", "is_express", "customer_rating", "total_amount",
    ]
    assert [r.order_id for r in df.orderBy("order_id").collect()][:2] == ["ORD-0000001", "ORD-0000002"]
    assert dict(df.dtypes)["order_date"] == "timestamp_ntz"


def test_distributions(spark):
    df = generate_orders(spark, N, num_partitions=4)
    freq = {r.product_category: r["count"] / N for r in df.groupBy("product_category").count().collect()}
    for cat, w in zip(C.GEN_CATEGORIES, C.GEN_CATEGORY_WEIGHTS):
        assert abs(freq[cat] - w) < 0.015, (cat, freq[cat])
    reg = {r.delivery_region: r["count"] / N for r in df.groupBy("delivery_region").count().collect()}
    for name, w in zip(C.GEN_REGIONS, C.GEN_REGION_WEIGHTS):
        assert abs(reg[name] - w) < 0.015, (name, reg[name])
    s = df.agg(
        F.avg(F.col("is_express").cast("double")).alias("express"),
        F.avg(F.col("customer_rating").isNull().cast("double")).alias("nulls"),
        F.avg("quantity").alias("qty"), F.min("quantity").alias("qmin"), F.max("quantity").alias("qmax"),
        F.avg(F.log("unit_price")).alias("lnp"),
        F.avg("customer_rating").alias("rating"),
        F.min("customer_rating").alias("rmin"), F.max("customer_rating").alias("rmax"),
        F.min("order_date").alias("dmin"), F.max("order_date").alias("dmax"),
        F.max(F.abs(F.col("total_amount") - F.col("quantity") * F.col("unit_price"))).alias("err"),
    ).first()
    assert abs(s.express - 0.25) < 0.015
    assert abs(s.nulls - 0.05) < 0.01
    assert abs(s.qty - 7.5) < 0.1 and (s.qmin, s.qmax) == (1, 14)
    assert abs(s.lnp - 3.2) < 0.03
    assert abs(s.rating - 4.0) < 0.05 and (s.rmin, s.rmax) == (1.0, 5.0)
    assert s.dmin.year == 2024 and s.dmax.year == 2024
    assert (s.dmax.month, s.dmax.day) <= (12, 30) and s.dmax.minute == 0
    assert s.err == 0.0


def test_no_shuffle_in_generation(spark):
    plan = generate_orders(spark, 100, num_partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_uniforms_are_in_open_unit_interval(spark):
    from ledgerlens.functions.random import hash_uniform
    df = spark.range(1, 5001).select(hash_uniform("id", "x", 1).alias("u"))
    s = df.agg(F.min("u").alias("lo"), F.max("u").alias("hi"), F.avg("u").alias("m")).first()
    assert 0.0 < s.lo and s.hi < 1.0 and math.isclose(s.m, 0.5, abs_tol=0.02)


def test_default_partitioning_grows_with_rows(spark):
    from ledgerlens.sources.generate import ROWS_PER_PARTITION, order_ids
    small = order_ids(spark, 10).rdd.getNumPartitions()
    assert small == spark.sparkContext.defaultParallelism
    big = order_ids(spark, ROWS_PER_PARTITION * 40).rdd.getNumPartitions()
    assert big == max(40, spark.sparkContext.defaultParallelism)


def test_slots_of_one_digest_are_uncorrelated_uniforms(spark):
    from ledgerlens.functions.random import hash_uniform
    n = 200_000
    df = spark.range(1, n + 1).select(
        *[hash_uniform("id", "a", 7, k).alias(f"a{k}") for k in range(4)],
        hash_uniform("id", "b", 7, 0).alias("b0"),
    )
    pairs = [("a0", "a1"), ("a0", "a2"), ("a1", "a3"), ("a2", "a3"), ("a0", "b0")]
    row = df.agg(*[F.corr(x, y).alias(f"{x}_{y}") for x, y in pairs],
                 *[F.avg(c).alias(f"m_{c}") for c in ("a0", "a1", "a2", "a3")],
                 *[F.var_pop(c).alias(f"v_{c}") for c in ("a0", "a3")]).first()
    bound = 4 / math.sqrt(n)  # about 4 standard errors of a correlation estimate
    for x, y in pairs:
        assert abs(row[f"{x}_{y}"]) < bound, (x, y, row[f"{x}_{y}"])
    for c in ("a0", "a1", "a2", "a3"):
        assert abs(row[f"m_{c}"] - 0.5) < 0.005
    for c in ("a0", "a3"):
        assert abs(row[f"v_{c}"] - 1 / 12) < 0.002


def test_first_row_fixture(spark):
    import datetime as dt
    row = generate_orders(spark, 1, num_partitions=1).first()
    assert tuple(row) == ("ORD-0000001", dt.datetime(2024, 4, 13, 14, 0), "Clothing", 9, 15.72,
                          "Moscow", False, 4.3, 9 * 15.72)
