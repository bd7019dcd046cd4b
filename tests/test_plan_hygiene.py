"""Physical-plan checks over every registered query of the order library (sf0.001).

No row-at-a-time Python, no cartesian or nested-loop joins, a limit only where
it is the feature (top-n report, ordered head), and no shuffle of raw rows:
every hash exchange sits on an aggregate (or an already reduced window or join
input), none deals rows round-robin, and a single partition only gathers partial
aggregates.  Frames that a query checkpoints or persists are checked before that.
"""

import re

import pytest

import __spark_entry__ as E
from ledgerlens.plans.single_pass import order_stats, reports_from_stats
from ledgerlens.plans.tuned import TunedReports
from ledgerlens.sources import files, tables

from .conftest import SF001

QUERIES = E._order_queries()
LIMITED = {"top_categories", "profile_head", "profile_file_head"}
#: Their result is a scan of what an earlier job wrote; the frames below stand for that job.
MATERIALIZED = {"single_pass_category_summary", "single_pass_express_by_region"}
#: Their rows are dealt once into a cache, on purpose: tests/test_plans.py looks at these plans.
TUNED = {"tuned_category_summary", "tuned_express_by_region"}
#: Steps or names are dealt by range, and joined with one row per part; the dictionary of
#: names meets one row per run and step.
RANGED = {"runlog_long_offsets", "runlog_step_blocks"}


def _frames(spark):
    lines = tables.order_lines(spark, SF001)
    frames = {name: QUERIES[name](spark, SF001) for name in QUERIES if name not in MATERIALIZED | TUNED}
    stats = order_stats(lines)
    frames["order_stats"] = stats
    for name, df in zip(("row_count", "category_summary", "express_by_region"), reports_from_stats(stats)):
        frames[f"single_pass_{name}"] = df
    return frames


@pytest.fixture(scope="module")
def frames(spark):
    return _frames(spark)


NAMES = sorted(set(QUERIES) - TUNED | {"order_stats", "single_pass_row_count"})


def blocks(plan):
    """The final plans of a plan's text, the main one's and its subqueries', as lines."""
    out, keep = [], True
    for line in plan.split("\n"):
        if "== Initial Plan ==" in line:
            keep = False
        elif "== Final Plan ==" in line or re.match(r"\s*[:+\- ]*(Subquery|AdaptiveSparkPlan)", line):
            keep = True
        if keep:
            out.append(line)
    return out


def raw_shuffles(plan):
    """Exchanges that move raw rows."""
    lines, found = blocks(plan), []
    for i, line in enumerate(lines):
        if "Exchange" not in line or "BroadcastExchange" in line or "ReusedExchange" in line:
            continue
        below = " ".join(lines[i + 1:i + 4])
        reduced = "Aggregate" in below or "Limit" in below or "Window" in below
        if "RoundRobin" in line or not reduced and ("SinglePartition" in line or "hashpartitioning" in line):
            found.append(line.strip())
    return found


@pytest.mark.parametrize("name", NAMES)
def test_plan_hygiene(frames, name):
    df = frames[name]
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)
    has_limit = "TakeOrderedAndProject" in plan or "CollectLimit" in plan or "GlobalLimit" in plan
    assert has_limit == (name in LIMITED), name
    if name not in RANGED:
        assert raw_shuffles(plan) == [], plan


def test_imputed_plans_are_checked_below_their_subquery(frames):
    df = frames["category_summary"]
    df.collect()
    text = "\n".join(blocks(df._jdf.queryExecution().executedPlan().toString()))
    assert text.count("Scan parquet") >= 2  # the subquery's scan and the main one


def test_a_round_robin_of_raw_rows_is_seen(spark):
    lines = tables.order_lines(spark, SF001)
    reports = TunedReports(lines, repartition=8, reports=("category_summary",))  # one report: not cached
    reports.category_summary.collect()
    assert raw_shuffles(reports.category_summary._jdf.queryExecution().executedPlan().toString())


def test_a_join_of_raw_rows_is_seen(spark):
    lines = tables.order_lines(spark, SF001)
    joined = lines.join(lines.select("order_id").hint("merge"), "order_id")
    joined.collect()
    assert raw_shuffles(joined._jdf.queryExecution().executedPlan().toString())


def test_record_sink_folders_do_not_grow_with_ids(spark, tmp_dir):
    import os
    rows = [{"experiment_id": f"r{i}", "total_time_sec": 1.0, "steps": {"s": 1.0}} for i in range(300)]
    files.write_run_records(tables.run_records(spark, rows), tmp_dir + "/r", buckets=4)
    assert len([d for d in os.listdir(tmp_dir + "/r") if d.startswith("bucket=")]) == 4
