"""Scale probe: generate N order lines as multi-file Parquet, time the job plans.

Usage: python tools/scale_probe.py OUT_DIR N_ROWS [CPUS] [HOT_SHARE]
HOT_SHARE (e.g. 0.6) puts that share of all rows into one category.
OUT_DIR must be a fresh folder.  Prints one JSON line of timings.  The data is
written once and then read by every plan, so the scan cost is real.  The
reports of the base and single-pass plans are compared with each other and
with DuckDB running the oracle SQL over the same files.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerlens import oracle  # noqa: E402
from ledgerlens.operators import clean, summaries  # noqa: E402
from ledgerlens.plans import TunedReports, single_pass_reports  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.generate import generate_orders  # noqa: E402


def main() -> None:
    out, n = sys.argv[1], int(sys.argv[2])
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    hot = float(sys.argv[4]) if len(sys.argv) > 4 else None
    weights = [hot] + [(1 - hot) / 4] * 4 if hot else None
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus * 4,
                          conf={"spark.driver.memory": "16g"})
    timings = {}
    t0 = time.perf_counter()
    generate_orders(spark, n, num_partitions=cpus * 8, category_weights=weights) \
        .write.mode("overwrite").parquet(out)
    timings["generate_write"] = time.perf_counter() - t0
    df = spark.read.parquet(out)

    def step(name, fn):
        t = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t, 3)

    imputed = clean.impute_mean(df, "customer_rating")
    step("read_count", lambda: summaries.row_count(df).collect())
    step("impute", lambda: clean.mean_value(df, "customer_rating").collect())
    step("category_summary", lambda: summaries.category_summary(imputed).collect())
    step("express_by_region", lambda: summaries.express_by_region(imputed).collect())
    timings["base_job_total"] = round(sum(timings[k] for k in (
        "read_count", "impute", "category_summary", "express_by_region")), 3)
    step("single_pass_job", lambda: [r.collect() for r in single_pass_reports(df)])

    def tuned():
        with TunedReports(df, repartition=cpus * 4) as t:
            t.row_count.collect()
            t.category_summary.collect()
            t.express_by_region.collect()
    step("tuned_job", tuned)
    timings["generate_write"] = round(timings["generate_write"], 3)

    base = ([tuple(r) for r in summaries.category_summary(imputed).collect()],
            [tuple(r) for r in summaries.express_by_region(imputed).collect()])
    _, sp_summary, sp_express = single_pass_reports(df)
    single = ([tuple(r) for r in sp_summary.collect()], [tuple(r) for r in sp_express.collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW order_lines AS SELECT * FROM read_parquet('{out}/*.parquet')")
    duck = ([tuple(r) for r in con.execute(
                "WITH " + oracle.IMPUTED + "\n" + oracle.category_summary_sql()).fetchall()],
            [tuple(r) for r in con.execute(
                oracle.express_by_region_sql(summaries.C.EXPRESS_AMOUNT_THRESHOLD)).fetchall()])
    checks = {"single_pass_equals_base": single == base, "duckdb_equals_base": duck == base}
    print(json.dumps({"rows": n, "cpus": cpus, "hot_share": hot, **timings, **checks}))
    spark.stop()


if __name__ == "__main__":
    main()
