"""Explicit schemas (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per order position.  ``order_date`` is timestamp_ntz: wall-clock
# time without zone, like the Parquet test tables and the generator output.
ORDER_LINES = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("order_date", T.TimestampNTZType(), True),
        T.StructField("product_category", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("unit_price", T.DoubleType(), True),
        T.StructField("delivery_region", T.StringType(), True),
        T.StructField("is_express", T.BooleanType(), True),
        T.StructField("customer_rating", T.DoubleType(), True),
        T.StructField("total_amount", T.DoubleType(), True),
    ]
)

# One job run: totals, Python-driver RSS readings and per-step seconds.
# ``steps`` has data-dependent keys, hence a map and not a struct.
RUN_RECORD = T.StructType(
    [
        T.StructField("experiment_id", T.StringType(), True),
        T.StructField("total_time_sec", T.DoubleType(), True),
        T.StructField("ram_start_mb", T.DoubleType(), True),
        T.StructField("ram_end_mb", T.DoubleType(), True),
        T.StructField("ram_delta_mb", T.DoubleType(), True),
        T.StructField("steps", T.MapType(T.StringType(), T.DoubleType()), True),
        T.StructField("timestamp", T.StringType(), True),
    ]
)

# Run configuration lookup.
RUN_META = T.StructType(
    [
        T.StructField("config", T.StringType(), False),
        T.StructField("label", T.StringType(), True),
        T.StructField("shuffle", T.IntegerType(), True),
        T.StructField("repartition", T.IntegerType(), True),
    ]
)

SPEEDUP_PAIRS = T.StructType(
    [
        T.StructField("pair", T.StringType(), False),
        T.StructField("base_config", T.StringType(), False),
        T.StructField("other_config", T.StringType(), False),
    ]
)
