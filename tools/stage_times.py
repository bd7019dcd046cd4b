"""Stage times of the order job from Spark's event log (no UI involved).

Usage: python tools/stage_times.py SCRATCH_DIR [sf_dir]
SCRATCH_DIR must be a fresh folder; the event log is written there.  The job
runs once to warm up and once measured; per job, the stages with their task
counts and durations in milliseconds are printed.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlens.operators import clean, summaries  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources import tables  # noqa: E402

MARK = "measured"


def run_job(spark, sf_dir: str) -> None:
    lines = tables.order_lines(spark, sf_dir)
    for step, fn in (
        ("count", lambda: summaries.row_count(lines).collect()),
        ("mean", lambda: clean.mean_value(lines, "customer_rating").first()),
    ):
        spark.sparkContext.setJobDescription(f"{MARK}:{step}")
        out = fn()
    fill = out.fill_value
    imputed = clean.fill_constant(lines, {"customer_rating": fill})
    for step, df in (("category report", summaries.category_summary(imputed)),
                     ("express report", summaries.express_by_region(imputed))):
        spark.sparkContext.setJobDescription(f"{MARK}:{step}")
        df.collect()
    spark.sparkContext.setJobDescription(None)


def main() -> None:
    log_dir = sys.argv[1]
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8, conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    global MARK
    MARK = "warm-up"
    run_job(spark, sf_dir)
    MARK = "measured"
    run_job(spark, sf_dir)
    spark.stop()
    (path,) = glob.glob(os.path.join(log_dir, "*"))
    jobs, stages = {}, {}
    with open(path) as fh:
        for line in fh:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                desc = e.get("Properties", {}).get("spark.job.description") or ""
                jobs[e["Job ID"]] = [desc, e["Submission Time"], None, [s["Stage ID"] for s in e["Stage Infos"]]]
            elif e["Event"] == "SparkListenerJobEnd":
                jobs[e["Job ID"]][2] = e["Completion Time"]
            elif e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Number of Tasks"], si["Completion Time"] - si["Submission Time"])
    for jid, (desc, start, end, sids) in sorted(jobs.items()):
        if not desc.startswith("measured:"):
            continue
        ran = [f"{stages[s][1]} ms/{stages[s][0]} tasks" for s in sids if s in stages]
        print(f"{desc.split(':', 1)[1]:16s} job {jid:3d} {end - start:5d} ms  stages: {', '.join(ran)}")


if __name__ == "__main__":
    main()
