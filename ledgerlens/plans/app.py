"""The order job as a Spark application: timed steps, reports, a run record.

    spark-submit --py-files ledgerlens.zip ledgerlens/plans/app.py --input hdfs://nn:9000/data/orders.csv \
        --results-dir hdfs://nn:9000/results --experiment-id 1dn_base [--plan tuned]

Steps, each a Spark job with a job description: read (scan + count), impute
(rating mean), group (category report), filter (express report).  Both reports
are printed; ``--output`` also stores them as Parquet.  The run record (total
and per-step seconds, Python driver memory) is written with
``files.write_job_record``: one folder per experiment id, replaced when the id
runs again.  ``--plan`` picks the single-pass plan (one scan, the default), the base
plan or the tuned plan (persisted, optionally repartitioned input).  A CSV is read
with the order-line schema unless ``--infer`` asks for one more pass.  With
``--output`` the reports are written first and printed from what was written.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens import constants as C
from ledgerlens.operators import clean, summaries
from ledgerlens.plans.single_pass import fill_value, order_stats, reports_from_stats
from ledgerlens.plans.tuned import TunedReports
from ledgerlens.session import build_session, checkpoint_root
from ledgerlens.sources import files, tables

READ, IMPUTE, GROUP, FILTER = C.RUN_STEP_NAMES
#: (measure, key) that each report is ranked by.
RANKED = {"category_summary": ("revenue", "product_category"), "express_by_region": ("express_revenue", "delivery_region")}


def driver_rss_mb() -> float:
    """Resident memory of this Python process in MB (the job's RAM reading)."""
    with open("/proc/self/statm") as statm:
        resident = int(statm.read().split()[1])
    return resident * os.sysconf("SC_PAGE_SIZE") / 2**20


class StepTimer:
    """Runs steps as described Spark jobs and keeps their wall-clock seconds."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.steps: dict[str, float] = {}

    def _describe(self, text: str | None) -> None:
        try:
            self.spark.sparkContext.setJobDescription(text)
        except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): timing only
            pass

    def run(self, name: str, fn: Callable[[], object]) -> object:
        self._describe(name)
        start = time.perf_counter()
        try:
            return fn()
        finally:
            self.steps[name] = time.perf_counter() - start
            self._describe(None)


def read_input(spark: SparkSession, path: str, fmt: str, infer: bool) -> DataFrame:
    if fmt == "parquet":
        return files.read_parquet(spark, path)
    return files.read_csv_inferred(spark, path) if infer else files.read_csv(spark, path)


def _print_count(df: DataFrame) -> None:
    print(f"rows: {summaries.row_count(df).first().row_count:,}")


def _show(title: str, df: DataFrame, rows: int) -> None:
    print(f"== {title}")
    df.show(rows, truncate=False)


def run_job(
    spark: SparkSession,
    input_path: str,
    experiment_id: str,
    results_dir: str,
    plan: str = "single-pass",
    fmt: str = "csv",
    infer: bool = False,
    threshold: float = C.EXPRESS_AMOUNT_THRESHOLD,
    repartition: int | None = None,
    show_rows: int = C.SHOW_ROWS,
    output_dir: str | None = None,
) -> dict:
    """Run the job once; returns the run record that was written."""
    ram_start = driver_rss_mb()
    timer = StepTimer(spark)
    started = time.perf_counter()
    holder: dict[str, DataFrame] = {}

    def report(name: str, df: DataFrame) -> None:
        if output_dir:
            path = f"{output_dir.rstrip('/')}/{name}"
            files.write_parquet(df, path)
            df = summaries.ranked(files.read_parquet(spark, path), *RANKED[name])
        _show(name.replace("_", " "), df, show_rows)

    def read_and_count() -> None:
        # Schema inference (when asked for) is part of reading, as in the job.
        holder["df"] = read_input(spark, input_path, fmt, infer)
        _print_count(holder["df"])

    if plan == "single-pass":
        checkpoint_root(spark)

        def read_stats() -> None:
            holder["df"] = read_input(spark, input_path, fmt, infer)
            holder["stats"] = order_stats(holder["df"], threshold).checkpoint(eager=True)
            print(f"rows: {reports_from_stats(holder['stats'])[0].first().row_count:,}")

        timer.run(READ, read_stats)
        stats = holder["stats"]
        timer.run(IMPUTE, lambda: fill_value(stats).first())
        _, summary, express = reports_from_stats(stats)
        timer.run(GROUP, lambda: report("category_summary", summary))
        timer.run(FILTER, lambda: report("express_by_region", express))
    elif plan == "tuned":
        timer.run(READ, read_and_count)
        with TunedReports(holder["df"], threshold, repartition) as tuned:
            timer.run(IMPUTE, lambda: tuned.row_count.collect())  # fills the cache
            timer.run(GROUP, lambda: report("category_summary", tuned.category_summary))
            timer.run(FILTER, lambda: report("express_by_region", tuned.express_by_region))
    elif plan == "base":
        timer.run(READ, read_and_count)
        df = holder["df"]
        fill = timer.run(IMPUTE, lambda: clean.mean_value(df, "customer_rating").first().fill_value)
        imputed = clean.fill_constant(df, {"customer_rating": fill}) if fill is not None else df
        timer.run(GROUP, lambda: report("category_summary", summaries.category_summary(imputed)))
        timer.run(FILTER, lambda: report("express_by_region", summaries.express_by_region(imputed, threshold)))
    else:
        raise ValueError(f"unknown plan {plan!r}")

    total = time.perf_counter() - started
    ram_end = driver_rss_mb()
    record = {
        "experiment_id": experiment_id,
        "total_time_sec": round(total, 2),
        "ram_start_mb": round(ram_start, 1),
        "ram_end_mb": round(ram_end, 1),
        "ram_delta_mb": round(ram_end - ram_start, 1),
        "steps": {k: round(v, 2) for k, v in timer.steps.items()},
        "timestamp": dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S"),
    }
    files.write_job_record(tables.run_records(spark, [record]), results_dir)
    return record


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--input", required=True, help="order-line CSV (header row) or Parquet path/URI")
    p.add_argument("--results-dir", required=True, help="folder of run records (shared storage)")
    p.add_argument("--experiment-id", default=os.environ.get("EXPERIMENT_ID", "1dn_base"))
    p.add_argument("--plan", choices=["single-pass", "base", "tuned"], default="single-pass")
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--infer", action="store_true", help="infer the CSV's column types (one more pass)")
    p.add_argument("--threshold", type=float, default=C.EXPRESS_AMOUNT_THRESHOLD)
    p.add_argument("--repartition", type=int, default=None, help="tuned plan: round-robin partitions")
    p.add_argument("--shuffle-partitions", type=int, default=None)
    p.add_argument("--show", type=int, default=C.SHOW_ROWS)
    p.add_argument("--output", default=None, help="also write the reports as Parquet here")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(argv)
    own = spark is None
    if own:
        spark = build_session(None, app_name=f"orders-{args.experiment_id}",
                              shuffle_partitions=args.shuffle_partitions)
    try:
        record = run_job(
            spark, args.input, args.experiment_id, args.results_dir, plan=args.plan,
            fmt=args.format, infer=args.infer, threshold=args.threshold,
            repartition=args.repartition, show_rows=args.show, output_dir=args.output,
        )
        print(f"run record: {record}")
        return record
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    main()
