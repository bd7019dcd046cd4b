"""Property test: every job plan equals a brute-force Python computation.

Random small order tables with null and NaN ratings, null keys, flags and
amounts; the base, single-pass and tuned plans must give the reports that a
direct row-by-row computation gives.
"""

import math
import os
from collections import defaultdict
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerlens.plans import TunedReports, base_reports, single_pass_reports

THRESHOLD = 50.0
SCHEMA = ("order_id string, product_category string, quantity int, delivery_region string, "
          "is_express boolean, customer_rating double, total_amount double")

rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["o1", "o2", "o3"])),
        st.one_of(st.none(), st.sampled_from(["A", "B", "C"])),
        st.one_of(st.none(), st.integers(1, 14)),
        st.one_of(st.none(), st.sampled_from(["R1", "R2"])),
        st.one_of(st.none(), st.booleans()),
        st.one_of(st.none(), st.just(float("nan")), st.integers(10, 50).map(lambda v: v / 10)),
        st.one_of(st.none(), st.integers(0, 20000).map(lambda c: c / 100)),
    ),
    max_size=25,
)


def _missing(x):
    return x is None or (isinstance(x, float) and math.isnan(x))


def brute_force(data):
    present = [r[5] for r in data if not _missing(r[5])]
    fill = None
    if present:
        # The decimal sum as a double over the count, rounded as Python rounds: by the binary value.
        fill = round(float(sum(Fraction(str(v)) for v in present)) / len(present), 1)
    cats = defaultdict(list)
    for r in data:
        cats[r[1]].append(r)
    summary = {}
    for key, rs in cats.items():
        ratings = [fill if _missing(r[5]) else r[5] for r in rs]
        ratings = [v for v in ratings if v is not None]
        qty = [r[2] for r in rs if r[2] is not None]
        amounts = [r[6] for r in rs if r[6] is not None]
        summary[key] = (
            sum(1 for r in rs if r[0] is not None),
            sum(round(a * 100) for a in amounts) / 100 if amounts else None,
            sum(ratings) / len(ratings) if ratings else None,
            sum(qty) / len(qty) if qty else None,
        )
    regions = defaultdict(list)
    for r in data:
        if r[4] is True and r[6] is not None and r[6] > THRESHOLD:
            regions[r[3]].append(r)
    express = {k: (sum(1 for r in rs if r[0] is not None), sum(round(r[6] * 100) for r in rs) / 100)
               for k, rs in regions.items()}
    return len(data), summary, express


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= 1e-6


def check(count_df, summary_df, express_df, expected):
    n, summary, express = expected
    assert count_df.first()[0] == n
    got = {r.product_category: (r.total_orders, r.revenue, r.avg_rating, r.avg_quantity)
           for r in summary_df.collect()}
    assert set(got) == set(summary)
    for key, (orders, revenue, rating, qty) in got.items():
        e = summary[key]
        assert orders == e[0] and revenue == e[1], (key, got[key], e)
        assert close(rating, e[2]) and close(qty, e[3]), (key, got[key], e)
    got_x = {r.delivery_region: (r.express_orders, r.express_revenue) for r in express_df.collect()}
    assert got_x == express


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")), deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(rows)
def test_all_plans_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    expected = brute_force(data)
    base = base_reports(df, THRESHOLD)
    check(base.row_count, base.category_summary, base.express_by_region, expected)
    check(*single_pass_reports(df, THRESHOLD, materialize=False), expected)
    with TunedReports(df, THRESHOLD, repartition=3) as t:
        check(t.row_count, t.category_summary, t.express_by_region, expected)


# --- run-log operators -----------------------------------------------------------

from ledgerlens import constants as C  # noqa: E402
from ledgerlens.operators import runlog  # noqa: E402
from ledgerlens.sources import tables  # noqa: E402

STEPS = ["s1", "s2", "s3"]
LOG_SCHEMA = "run_id string, config string, step string, step_pos int, secs double"

logs = st.dictionaries(
    keys=st.tuples(st.sampled_from(["r1", "r2", "r3", "r4"]), st.sampled_from(STEPS)),
    values=st.integers(0, 50000).map(lambda c: c / 100),
    max_size=12,
)


def _log_rows(entries):
    config = {"r1": "1dn_base", "r2": "1dn_opt", "r3": "1dn_base", "r4": "zzz"}
    return [(run, config[run], step, STEPS.index(step) + 1, secs) for (run, step), secs in entries.items()]


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")), deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(logs)
def test_runlog_operators_match_brute_force(spark, entries):
    rows = _log_rows(entries)
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    cents = {(r[0], r[2]): round(r[4] * 100) for r in rows}

    offsets = {(r.run_id, r.step): r.offset for r in runlog.stack_offsets(log).collect()}
    for run, _, step, pos, _ in rows:
        earlier = sum(c for (rr, s), c in cents.items() if rr == run and STEPS.index(s) + 1 < pos)
        assert offsets[(run, step)] == earlier / 100

    pivot = {r.run_id: tuple(r[s] for s in STEPS) for r in runlog.step_pivot(log, STEPS).collect()}
    runs = {r[0] for r in rows}
    assert set(pivot) == runs
    for run in runs:
        assert pivot[run] == tuple(entries.get((run, s), 0.0) for s in STEPS)

    totals = {r.run_id: (r.total_time_sec, r.n_steps) for r in runlog.run_totals(log).collect()}
    for run in runs:
        mine = [c for (rr, _), c in cents.items() if rr == run]
        assert totals[run] == (sum(mine) / 100, len(mine))

    by_config = defaultdict(int)
    for run, cfg, step, _, _ in rows:
        by_config[cfg] += cents[(run, step)]
    ctot = {r.config: r.total_secs for r in runlog.config_totals(log).collect()}
    assert ctot == {k: v / 100 for k, v in by_config.items()}

    sp = {r.pair: r.speedup for r in runlog.speedups(
        runlog.config_totals(log), tables.speedup_pairs(spark)).collect()}
    for pair, base, other in C.SPEEDUP_PAIRS:
        b, o = ctot.get(base), ctot.get(other)
        want = None if b is None or o is None or o == 0 else b / o
        assert sp[pair] == want, (pair, sp[pair], want)

    back = runlog.steps_long(runlog.records_from_log(log))
    got = sorted((r.run_id, r.step, r.step_pos, r.secs) for r in back.collect())
    want = []
    for run in runs:
        mine = sorted((STEPS.index(s), s, v) for (rr, s), v in entries.items() if rr == run)
        want += [(run, s, i + 1, v) for i, (_, s, v) in enumerate(mine)]
    assert got == sorted(want)


# --- fill value: one answer for every partitioning ---------------------------------

from ledgerlens.operators.clean import mean_value  # noqa: E402


@settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "10")), deadline=None, derandomize=True,
          suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(10, 50), min_size=1, max_size=40))
def test_fill_is_exact_and_partition_invariant(spark, tenths):
    values = [t / 10 for t in tenths]
    df = spark.createDataFrame([(v,) for v in values], "r double")
    fills = {mean_value(df.repartition(p), "r").first().fill_value for p in (1, 3, 7)}
    assert fills == {round(sum(tenths) / 10 / len(tenths), 1)}
