"""Run-record analysis as a Spark application (the numbers behind the charts).

    spark-submit --py-files ledgerlens.zip ledgerlens/plans/analysis.py --records hdfs://nn:9000/results

Reads every run record below ``--records`` (pretty-printed ``*.json`` files or
``write_run_records`` folders) and prints: runs in the fixed order with their
configuration, the step table, stacked offsets of each step, totals with RAM
growth, speedups of the configured pairs, and records whose configuration is
unknown.  ``--show`` rows of each table are printed; ``--output`` stores each whole
table as Parquet, and what is printed is then read from there.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import runlog
from ledgerlens.session import build_session
from ledgerlens.sources import files, tables


SHOW_ROWS = 20
#: How the tables are ordered when they are printed.
ORDER = {
    "runs": ("sort_key", "experiment_id"), "step_table": ("run_id",), "stack_offsets": ("run_id", "step_pos"),
    "labelled_steps": ("run_id", "step_pos"), "totals": ("experiment_id",), "speedups": ("pair",),
    "unknown_configs": ("experiment_id",),
}


def analysis_tables(
    spark: SparkSession, records: DataFrame, steps: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """All analysis tables from a frame of run records.

    The step table has all distinct steps, which one small job collects while the
    table is built; give ``steps`` (e.g. ``runlog.first_record_steps``) for others.
    """
    runs = runlog.with_custom_order(
        records.select("experiment_id", F.col("experiment_id").alias("config"), "total_time_sec"),
        "config")
    long = runlog.steps_long(records)
    totals = records.select(F.col("experiment_id").alias("config"),
                            F.col("total_time_sec").alias("total_secs"))
    return {
        "runs": runlog.enrich(runs).orderBy("sort_key", "experiment_id"),
        "step_table": runlog.with_custom_order(runlog.step_pivot(long, steps), "run_id")
        .orderBy("sort_key", "run_id").drop("sort_key"),
        "stack_offsets": runlog.stack_offsets(long).orderBy("run_id", "step_pos"),
        "labelled_steps": runlog.visible_steps(long).orderBy("run_id", "step_pos"),
        "totals": runlog.record_summary(records).orderBy("experiment_id"),
        "speedups": runlog.speedups(totals, tables.speedup_pairs(spark)).orderBy("pair"),
        "unknown_configs": runlog.unknown_configs(runs, run="experiment_id"),
    }


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--records", required=True, help="folder or glob of run records")
    p.add_argument("--json-lines", action="store_true", help="records are JSON lines, not one object per file")
    p.add_argument("--first-record-steps", action="store_true", help="step table: only the steps of the first record")
    p.add_argument("--show", type=int, default=SHOW_ROWS, help="rows of each table to print")
    p.add_argument("--output", default=None, help="also write every table as Parquet here")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, DataFrame]:
    args = parse_args(argv)
    own = spark is None
    if own:
        spark = build_session(None, app_name="run-record-analysis")
    try:
        # read once for all tables
        records = files.read_run_records(spark, args.records, multi_line=not args.json_lines).persist()
        steps = runlog.first_record_steps(records) if args.first_record_steps else None
        out = analysis_tables(spark, records, steps)
        for name, df in out.items():
            if args.output:
                path = f"{args.output.rstrip('/')}/{name}"
                files.write_parquet(df, path)
                order = ORDER[name]
                out[name] = df = files.read_parquet(spark, path).orderBy(*order)
            print(f"== {name}")
            df.show(args.show, truncate=False)
        if args.output:
            records.unpersist()
        return out
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
