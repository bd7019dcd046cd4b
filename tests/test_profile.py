import os

import pytest

from ledgerlens.operators import profile
from ledgerlens.sources import tables

from .conftest import SF01


def test_shape_and_null_counts_on_order_lines(spark):
    ol = tables.order_lines(spark, SF01)
    shape = profile.profile_shape(ol).first()
    assert (shape.n_rows, shape.n_cols) == (60000, 9)
    nulls = {r.column_name: r.null_count for r in profile.profile_null_counts(ol).collect()}
    assert nulls["customer_rating"] == 3036
    assert sum(nulls.values()) == 3036


def test_null_counts_include_nan_and_use_one_aggregate(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, float("nan"), None)], "a int, b double, c string")
    got = [(r.ordinal, r.column_name, r.null_count) for r in profile.profile_null_counts(df).collect()]
    assert got == [(1, "a", 1), (2, "b", 2), (3, "c", 1)]
    plan = profile.profile_null_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # one partial + one final for all columns


def test_dtypes(spark):
    ol = tables.order_lines(spark, SF01)
    got = [(r.column_name, r.data_type) for r in profile.profile_dtypes(spark, ol).collect()]
    assert got[1] == ("order_date", "timestamp_ntz")
    assert got[6] == ("is_express", "boolean")


def test_head_is_ordered_top_k(spark):
    orders = tables.read_table(spark, SF01, "orders")
    head = profile.profile_head(orders, 3, ["o_orderkey"])
    assert [r.o_orderkey for r in head.collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in head._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        profile.profile_head(orders, 3, [])


def test_profile_columns_types_and_counts(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, float("nan"), None), (3, 2.0, "c")],
                               "a int, b double, c string")
    got = [tuple(r) for r in profile.profile_columns(df).collect()]
    assert got == [(1, "a", "int", 2), (2, "b", "double", 1), (3, "c", "string", 2)]


def test_head_breaks_ties_deterministically(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (0, "z")], "k int, v string")
    assert [tuple(r) for r in profile.profile_head(df, 2, ["k"]).collect()] == [(0, "z"), (1, "a")]


@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_file_head_is_the_first_lines_for_any_split(spark, tmp_dir, split):
    """Lines in no order of their values, over several files and many splits."""
    lines = [f"{(i * 7919) % 1000},{'x' * (i % 40)},{i}" for i in range(600)]
    os.makedirs(tmp_dir + "/csv")
    for f in range(3):
        with open(f"{tmp_dir}/csv/part-{f}.csv", "w") as out:
            out.write("\n".join(["k,v,_row", *lines[f * 200:(f + 1) * 200]]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = spark.read.option("header", True).csv(tmp_dir + "/csv")
        for n in (1, 5, 250):
            head = profile.file_head(df, n)
            assert [",".join(x or "" for x in r) for r in head.collect()] == lines[:n]
        assert head.columns == ["k", "v", "_row"]
        assert "TakeOrderedAndProject" in head._jdf.queryExecution().executedPlan().toString()
        assert profile.file_head(df.where("k = 'none'"), 3).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
