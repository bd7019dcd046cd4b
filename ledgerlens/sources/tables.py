"""Adapters from the shared test tables to the order-line and run-log shapes.

``order_lines`` maps TPC-H ``lineitem`` onto the order-line schema and
``run_log`` folds the ``events`` table into one row per (run, step).  Both are
plain projections/aggregates, so Catalyst prunes the lineitem/events scan to
the columns a query actually uses and pushes its filters into the Parquet
reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import constants as C
from ledgerlens import schemas
from ledgerlens.functions.money import money_sum
from ledgerlens.functions.ordering import list_position

# --- fixed values: fixture mapping of events onto run configurations ----------
EVENT_STEP_ORDER = ["view", "click", "signup", "purchase", "error"]
EVENT_CONFIGS = ["1dn_base", "1dn_opt", "3dn_base", "3dn_opt", "zzz"]  # user_id % 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as order lines (one row per order position)."""
    li = read_table(spark, sf_dir, "lineitem")
    rating = F.when(
        (F.col("l_orderkey") + F.col("l_suppkey")) % 20 == 7, F.lit(None).cast("double")
    ).otherwise(F.round(F.lit(1.0) + F.col("l_discount") * 40.0, 1))
    return li.select(
        F.format_string("ORD-%07d", F.col("l_orderkey")).alias("order_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("order_date"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("product_category"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.concat(F.lit("R"), (F.col("l_suppkey") % 5).cast("string")).alias("delivery_region"),
        (F.col("l_partkey") % 4 == 0).alias("is_express"),
        rating.alias("customer_rating"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a long run log: run = user, step = event type, secs = sum of value."""
    ev = read_table(spark, sf_dir, "events")
    bucket = F.col("user_id") % 5
    config = F.when(bucket == 0, EVENT_CONFIGS[0])
    for i, name in enumerate(EVENT_CONFIGS[1:-1], start=1):
        config = config.when(bucket == i, name)
    config = config.otherwise(EVENT_CONFIGS[-1])
    steps = (
        ev.groupBy("user_id", "event_type")
        .agg(money_sum("value").alias("secs"))
    )
    return steps.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("run_id"),
        config.alias("config"),
        F.col("event_type").alias("step"),
        list_position("event_type", EVENT_STEP_ORDER).alias("step_pos"),
        F.col("secs"),
    )


def run_meta(
    spark: SparkSession, rows: Sequence[tuple] | None = None
) -> DataFrame:
    """Run configuration lookup (config, label, shuffle, repartition)."""
    return spark.createDataFrame(list(rows or C.RUN_META_ROWS), schemas.RUN_META)


def run_records(spark: SparkSession, records: Sequence[dict]) -> DataFrame:
    """Run records given as dicts (the job's own record shape), step order kept.

    ``createDataFrame`` turns a dict into a map through an unordered hash map,
    so the steps travel as two arrays and become a map inside Spark.
    """
    fields = [f for f in schemas.RUN_RECORD.fields if f.name != "steps"]
    transport = T.StructType(
        fields + [T.StructField("step_names", T.ArrayType(T.StringType())),
                  T.StructField("step_secs", T.ArrayType(T.DoubleType()))])
    def value(f: T.StructField, v):
        return float(v) if v is not None and isinstance(f.dataType, T.DoubleType) else v

    rows = [
        tuple(value(f, rec.get(f.name)) for f in fields)
        + (list((rec.get("steps") or {}).keys()), [float(v) for v in (rec.get("steps") or {}).values()])
        for rec in records
    ]
    df = spark.createDataFrame(rows, transport)
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) if f.name != "steps"
          else F.map_from_arrays("step_names", "step_secs").alias("steps")
          for f in schemas.RUN_RECORD.fields]
    )


def speedup_pairs(spark: SparkSession, rows: Sequence[tuple] | None = None) -> DataFrame:
    """Pairs of configurations to compare: speedup = base total / other total."""
    return spark.createDataFrame(list(rows or C.SPEEDUP_PAIRS), schemas.SPEEDUP_PAIRS)
