"""Sums and means that lose nothing and cannot overflow, with ANSI on and off."""

import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.money import WEIGHTS, Parts, exact_mean, money_sum, parts, round_half_even, total
from ledgerlens.operators import clean, runlog, summaries
from ledgerlens.plans import single_pass_reports


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield spark
    spark.conf.set("spark.sql.ansi.enabled", before)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("values, want", [
    ([0.004] * 1000, 4.0),
    ([6e16, 6e16], 1.2e17),
    ([1e13, 0.01], 1e13 + 0.01),
    ([math.inf, 1.0], math.inf),
    ([1e300, 1e300], 2e300),
    ([0.1] * 3, 0.3),
    ([-0.004, 0.01, None, math.nan], 0.006),
    ([None], None),
    ([], None),
])
def test_sum(ansi, values, want):
    got = frame(ansi, values).agg(money_sum("x").alias("s")).first().s
    assert got == want


def spread(rng):
    """A double of any magnitude that the digits cover, or a whole-cent one."""
    return rng.choice([rng.choice([-1, 1]) * rng.uniform(0.5, 1) * 2.0 ** rng.randint(-54, 58), rng.randint(-10**9, 10**9) / 100, 0.0, -0.0])


def test_sums_equal_fsum_to_the_last_bit(spark):
    """Groups of mixed magnitudes with cancellation, in several orders and partitionings."""
    rng = random.Random(17)
    groups = {g: [spread(rng) for _ in range(rng.choice([1, 2, 3, 40]))] + [0.001] for g in range(150)}
    groups |= {1000 + g: (x := [spread(rng) for _ in range(20)]) + [-v for v in x] + [2.0**-55, 1e-3] for g in range(50)}
    groups |= {2000: [1e15 + 0.25, 0.004, 123456789012.345], 2001: [123456789012345.0, 0.004], 2002: [2.0**58, 1.0 + 2.0**-52, -2.0**58],
               2003: [2.0**53, 1.0, 2.0**-50], 2004: [2.0**53, 1.0, -(2.0**-50)], 2005: [2.0**53 + 2, 1.0], 2006: [1e-9] * 999 + [0.5]}
    rows = [(g, x) for g, values in groups.items() for x in values]
    want = {g: math.fsum(values) for g, values in groups.items()}
    for n, order in ((1, rows), (5, rows[::-1]), (7, rng.sample(rows, len(rows)))):
        df = spark.createDataFrame(order, "g int, x double").repartition(n)
        got = {r.g: r.s for r in df.groupBy("g").agg(money_sum("x").alias("s")).collect()}
        assert got == want


def test_values_beyond_the_digits_cost_no_others(spark):
    for values, want in (([123456789012345.0, 1e-30], 123456789012345.0), ([1e300, 0.01, -1e300], 0.01), ([2.0**-60, 1e-20, -(2.0**-60)], 1e-20)):
        assert frame(spark, values).agg(money_sum("x").alias("s")).first().s == want
    assert math.isclose(frame(spark, [1e-30, 2e-30]).agg(money_sum("x").alias("s")).first().s, 3e-30, rel_tol=1e-12)


def test_whole_cents_sum_as_decimals(spark):
    rng = random.Random(23)
    groups = {g: [rng.randint(-10**7, 10**9) / 100 for _ in range(rng.choice([1, 3, 200]))] for g in range(100)}
    df = spark.createDataFrame([(g, x) for g, values in groups.items() for x in values], "g int, x double").repartition(4)
    got = {r.g: r.s for r in df.groupBy("g").agg(money_sum("x").alias("s")).collect()}
    assert got == {g: float(sum(Decimal(repr(x)) for x in values)) for g, values in groups.items()}


@pytest.mark.parametrize("values, want", [
    ([4e-7] * 10, 4e-7),
    ([math.inf, 1.0], math.inf),
    ([9.3e12, 9.3e12], 9.3e12),
    ([4.8, 1.3, 2.7, 3.8], 3.15),
    ([None, 2.0, 4.0], 3.0),
])
def test_mean(ansi, values, want):
    got = frame(ansi, values).agg(exact_mean("x").alias("m")).first().m
    assert got == want
    assert summaries.mean_of(frame(ansi, [4e-7] * 4), "x", "m", scale=10).first().m == 4e-7


def test_totals_beyond_a_bigint(ansi):
    """Sums of digits whose whole passes 9.2e18 many times over."""
    for big in (1 << 62, -(1 << 62), (1 << 61) + 12345, 3):
        row = ansi.range(1).select(F.lit(big).alias("d"), F.lit(0.0).alias("r"), F.lit(1).cast("bigint").alias("odd"))
        got = row.select(total(Parts((F.col("d"),) * len(WEIGHTS), F.col("r"), F.col("odd")), 2).alias("t")).first().t
        assert got == float(sum(Fraction(big) * Fraction(2) ** w for w in WEIGHTS))
    for value in (float(1 << 58), -float(1 << 58), 123456789012.0, -1.0, 0.1, 1e-9, -123.456):
        for whole in {False, value == int(value)}:
            p = ansi.createDataFrame([(value,)], "x double").select(*parts("x", 0, whole).columns("p")).first().asDict()
            digits = [p[f"p_d{i}"] for i in range(3 if whole else len(WEIGHTS))]
            assert sum(d * Fraction(2) ** w for d, w in zip(digits, WEIGHTS)) == Fraction(value) and p["p_rest"] == 0
            assert max(map(abs, digits)) <= 1 << 23


def test_order_does_not_show(spark):
    values = [0.1 * i + 1e-4 / (i + 1) for i in range(500)] + [3e13, -3e13, 1e-9]
    sums = {spark.createDataFrame([(v,) for v in order], "x double").repartition(n).agg(money_sum("x").alias("s")).first().s
            for order in (values, values[::-1]) for n in (1, 3, 7)}
    assert len(sums) == 1


def test_offsets_of_small_steps(ansi):
    log = ansi.createDataFrame([("r", "c", s, i, x) for i, (s, x) in enumerate([("a", 0.004), ("b", 0.004), ("c", 1.0)], 1)],
                               "run_id string, config string, step string, step_pos int, secs double")
    got = {r.step: r.offset for r in runlog.stack_offsets(log).collect()}
    assert got == {"a": 0.0, "b": 0.004, "c": 0.008}
    assert runlog.step_pivot(log.union(log)).first().asDict() == {"run_id": "r", "a": 0.008, "b": 0.008, "c": 2.0}
    raw = log.union(log).union(log)
    assert {r.step: r.offset for r in runlog.stack_offsets(raw).collect()} == {"a": 0.0, "b": 0.012, "c": 0.024}
    assert runlog.records_from_log(raw).first().steps == {"a": 0.012, "b": 0.012, "c": 3.0}


@pytest.mark.parametrize("x", [3.25, 3.15, 3.35, 0.05, 0.15, 0.25, 4.75, -3.25, -3.15, 2.0, 2.04, 2.96, 0.0, 1e15 + 0.5, 1e300,
                               3.05, 4.45, 2.675, 0.45000000000000001, 0.44999999999999996])
def test_rounding_is_half_even_on_the_binary_value(spark, x):
    assert spark.createDataFrame([(x,)], "x double").select(round_half_even(F.col("x"), 1).alias("r")).first().r == round(x, 1)


def test_a_tied_mean_fills_the_even_digit(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (None,)], "x double")
    assert clean.mean_value(df, "x").first().fill_value == 3.2


def test_imputed_columns_keep_their_digits(spark):
    df = spark.createDataFrame([(9007199254740993,), (None,)], "x bigint")
    got = [r.x for r in clean.impute_mean(df, "x").collect()]
    assert int(got[0]) == 9007199254740993
    dec = spark.sql("SELECT CAST(x AS DECIMAL(20,4)) AS x FROM VALUES ('1234567890123456.7891'), (NULL), ('1.0001') AS t(x)")
    rows = sorted(str(r.x) for r in clean.impute_mean(dec, "x").collect())
    assert "1234567890123456.7891" in rows and len(rows) == 3


def test_plans_agree_on_hard_amounts(spark):
    rows = [(f"o{i}", c, q, r, e, rate, a) for i, (c, q, r, e, rate, a) in enumerate([
        ("A", 1, "x", True, 4.8, 200.004), ("A", 2, "x", True, 1.3, 1e13), ("B", 3, "y", True, None, 0.004), ("B", 4, "y", False, 2.7, 150.0),
        ("C", 5, "z", True, 3.8, float("inf")), ("C", None, "z", True, float("nan"), None)])]
    df = spark.createDataFrame(rows, "order_id string, product_category string, quantity int, delivery_region string, is_express boolean, "
                                     "customer_rating double, total_amount double")
    _, summary, express = single_pass_reports(df)
    imputed = clean.impute_mean(df, "customer_rating")
    assert sorted(map(str, summary.collect())) == sorted(map(str, summaries.category_summary(imputed).collect()))
    assert sorted(map(str, express.collect())) == sorted(map(str, summaries.express_by_region(imputed).collect()))
