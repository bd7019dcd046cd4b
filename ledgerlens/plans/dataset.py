"""Synthetic order dataset as a Spark application: generate, write, profile.

    spark-submit --py-files ledgerlens.zip ledgerlens/plans/dataset.py \
        --rows 120000 --output hdfs://nn:9000/data/orders.csv

Generates the order lines on Spark (partition-invariant, see
``sources.generate``), writes them as header CSV without an index column (or
Parquet), then profiles what was written: shape, column types, missing values
per column, first rows by order id.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerlens import constants as C
from ledgerlens.operators import profile
from ledgerlens.session import build_session
from ledgerlens.sources import files
from ledgerlens.sources.generate import generate_orders


def make_dataset(spark: SparkSession, rows: int, output: str, seed: int = C.GEN_SEED,
                 fmt: str = "csv", num_partitions: int | None = None, head: int = 3) -> dict:
    orders = generate_orders(spark, rows, seed, num_partitions)
    if fmt == "csv":
        files.write_csv(orders, output)
        written = files.read_csv(spark, output)
    else:
        files.write_parquet(orders, output)
        written = files.read_parquet(spark, output)
    shape = profile.profile_shape(written).first()
    print(f"size: {shape.n_rows:,} rows x {shape.n_cols} columns")
    print("types:")
    profile.profile_dtypes(spark, written).show(truncate=False)
    print("missing values:")
    nulls = profile.profile_null_counts(written)
    nulls.show(truncate=False)
    print(f"first {head} rows:")
    profile.profile_head(written, head, ["order_id"]).show(truncate=False)
    return {"n_rows": shape.n_rows, "n_cols": shape.n_cols,
            "nulls": {r.column_name: r.null_count for r in nulls.collect()}}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--rows", type=int, default=C.GEN_ROWS)
    p.add_argument("--seed", type=int, default=C.GEN_SEED)
    p.add_argument("--output", required=True)
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--partitions", type=int, default=None)
    args = p.parse_args(argv)
    own = spark is None
    if own:
        spark = build_session(None, app_name="order-dataset")
    try:
        return make_dataset(spark, args.rows, args.output, args.seed, args.format, args.partitions)
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
