"""Benchmark: the order job and its variants at ``$BENCH_SF_DIR``.

Prints ONE JSON line: {"metric", "value", "unit", "queries": {...}, "sf", ...}.
``value`` is the median total of the order job's four steps on Parquet input
(count, rating mean, category report, express report), the same steps the
published run records time, run like ``ledgerlens.plans.app --plan base``.  Each query is warmed up once and then timed
``$BENCH_RUNS`` times (default 5); the median is reported.

Only small results (report rows) reach the driver; full evaluation of the
generator uses the ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlens import constants as C  # noqa: E402
from ledgerlens.operators import clean, runlog, summaries  # noqa: E402
from ledgerlens.plans import TunedReports, single_pass_reports  # noqa: E402
from ledgerlens.session import build_session, remove_scratch, scratch_path  # noqa: E402
from ledgerlens.sources import files, generate, tables  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
THRESHOLD = C.EXPRESS_AMOUNT_THRESHOLD


def sf_of(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)$", path)
    return float(m.group(1)) if m else path


def timed(spark, label, fn):
    spark.sparkContext.setJobDescription(label)
    t0 = time.perf_counter()
    fn()
    elapsed = time.perf_counter() - t0
    spark.sparkContext.setJobDescription(None)
    return elapsed


def main() -> None:
    spark = build_session(f"local[{CPUS}]", app_name="ledgerlens-bench", shuffle_partitions=CPUS,
                          conf={"spark.driver.memory": "8g"})
    lines = tables.order_lines(spark, SF_DIR)

    # Setup (untimed): the order lines as a header CSV, the job's own input format.
    csv_dir = scratch_path(spark, "bench-orders-csv")
    files.write_csv(lines, csv_dir)

    def job_steps(df):
        # As the job app's base plan runs it: the impute step computes the
        # rounded mean once (one number to the driver) and both reports fill
        # with it, instead of each recomputing it as a subquery.
        state = {}

        def impute():
            state["fill"] = clean.mean_value(df, "customer_rating").first().fill_value

        def imputed():
            fill = state.get("fill")
            return clean.fill_constant(df, {"customer_rating": fill}) if fill is not None else df

        return {
            "read_count": lambda: summaries.row_count(df).collect(),
            "impute": impute,
            "category_summary": lambda: summaries.category_summary(imputed()).collect(),
            "express_by_region": lambda: summaries.express_by_region(imputed(), THRESHOLD).collect(),
        }

    def csv_job():
        df = files.read_csv_inferred(spark, csv_dir)
        for step in job_steps(df).values():
            step()

    def single_pass_job():
        for report in single_pass_reports(lines, THRESHOLD):
            report.collect()

    def tuned_job():
        with TunedReports(lines, THRESHOLD) as t:
            t.row_count.collect()
            t.category_summary.collect()
            t.express_by_region.collect()

    n_rows = summaries.row_count(lines).first().row_count

    def generate_job():
        (generate.generate_orders(spark, n_rows, num_partitions=CPUS)
         .write.format("noop").mode("overwrite").save())

    def runlog_job():
        log = tables.run_log(spark, SF_DIR)
        runlog.speedups(runlog.config_totals(log), tables.speedup_pairs(spark)).collect()
        runlog.step_pivot(log).collect()
        runlog.stack_offsets(log, pre_aggregated=True).collect()

    def record_sink(read) -> None:
        path = scratch_path(spark, "bench-run-records")
        files.write_run_records(runlog.records_from_log(tables.run_log(spark, SF_DIR), pre_aggregated=True), path)
        read(files.read_run_records(spark, path, multi_line=False)).collect()
        remove_scratch(spark, path)

    queries = dict(job_steps(lines))
    queries.update({
        "csv_job_infer_total": csv_job,
        "single_pass_job": single_pass_job,
        "tuned_job": tuned_job,
        "generate_orders": generate_job,
        "runlog_analytics": runlog_job,
        "runlog_scan_json": lambda: record_sink(lambda r: r.select("experiment_id", "total_time_sec", F.size("steps"))),
        "runlog_roundtrip_json": lambda: record_sink(runlog.steps_long),
    })

    samples: dict[str, list[float]] = {k: [] for k in queries}
    for name, fn in queries.items():
        timed(spark, f"warmup {name}", fn)
    for _ in range(RUNS):
        for name, fn in queries.items():
            samples[name].append(timed(spark, name, fn))

    med = {k: round(statistics.median(v), 4) for k, v in samples.items()}
    steps = ("read_count", "impute", "category_summary", "express_by_region")
    job_totals = [sum(samples[s][i] for s in steps) for i in range(RUNS)]
    total = round(statistics.median(job_totals), 4)
    med["order_job_total"] = total

    # The timings as run records (the job's own format), written and read back,
    # and compared with the run-log operators.
    variants = {
        "base": (total, {s: med[s] for s in steps}),
        "csv": (med["csv_job_infer_total"], {}),
        "tuned": (med["tuned_job"], {}),
        "single_pass": (med["single_pass_job"], {}),
    }
    records = tables.run_records(spark, [
        {"experiment_id": k, "total_time_sec": v, "steps": st} for k, (v, st) in variants.items()])
    rec_dir = scratch_path(spark, "bench-run-records")
    files.write_run_records(records, rec_dir)
    back = files.read_run_records(spark, rec_dir, multi_line=False)
    totals = back.select(F.col("experiment_id").alias("config"), F.col("total_time_sec").alias("total_secs"))
    pairs = tables.speedup_pairs(spark, [
        ("tuned_vs_base", "base", "tuned"),
        ("single_pass_vs_base", "base", "single_pass"),
        ("parquet_vs_csv", "csv", "base"),
    ])
    speedups = {r.pair: round(r.speedup, 3) for r in runlog.speedups(totals, pairs).collect()}
    for path in (csv_dir, rec_dir):
        remove_scratch(spark, path)
    out = {
        "metric": "order_job_total_sec",
        "value": total,
        "unit": "sec",
        "queries": med,
        "sf": sf_of(SF_DIR),
        "rows": n_rows,
        "rows_per_sec": round(n_rows / total, 1) if total else None,
        "runs": RUNS,
        "cpus": CPUS,
        "speedups": speedups,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
