"""The published workload shape, end to end: 120,000 generated order lines as
header CSV, then the job app (schema inference, four timed steps) in each plan.

Usage: python tools/reference_workload.py SCRATCH_DIR
SCRATCH_DIR must be a fresh folder.  Prints the run record of every plan.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.plans import app, dataset  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402


def main() -> None:
    d = sys.argv[1].rstrip("/")
    spark = build_session("local[8]", shuffle_partitions=4)
    dataset.main(["--rows", "120000", "--output", f"{d}/orders.csv"], spark=spark)
    runs = (("warm-up", "base", []), ("1dn_base", "base", []),
            ("1dn_opt", "tuned", ["--repartition", "8"]), ("single_pass", "single-pass", []))
    records = [app.main(["--input", f"{d}/orders.csv", "--results-dir", f"{d}/results",
                         "--experiment-id", exp, "--plan", plan, "--infer", "--show", "20"] + extra, spark=spark)
               for exp, plan, extra in runs]
    for r in records[1:]:
        print("RECORD", r["experiment_id"], r["total_time_sec"], r["steps"])
    spark.stop()


if __name__ == "__main__":
    main()
