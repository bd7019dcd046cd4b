import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.operators import runlog
from ledgerlens.sources import files, tables

from .conftest import SF01

# --- fixed values: the four published run records -----------------------------
STEP_NAMES = C.RUN_STEP_NAMES
PUBLISHED = [
    ("1dn_base", 7.77, 26.8, 27.0, 0.1, [5.77, 0.52, 0.88, 0.6], "2026-04-08 01:10:28"),
    ("1dn_opt", 5.69, 27.0, 27.1, 0.1, [3.58, 0.74, 0.87, 0.46], "2026-04-08 01:13:38"),
    ("3dn_base", 5.1, 27.0, 27.2, 0.2, [3.64, 0.36, 0.68, 0.41], "2026-04-08 01:15:12"),
    ("3dn_opt", 6.17, 26.8, 27.0, 0.2, [3.86, 0.8, 0.96, 0.5], "2026-04-08 01:16:58"),
]


@pytest.fixture()
def records_dir(tmp_dir):
    """The records as the job writes them: one pretty-printed UTF-8 object per file."""
    for exp, total, r0, r1, dr, steps, ts in PUBLISHED:
        rec = {"experiment_id": exp, "total_time_sec": total, "ram_start_mb": r0, "ram_end_mb": r1,
               "ram_delta_mb": dr, "steps": dict(zip(STEP_NAMES, steps)), "timestamp": ts}
        with open(os.path.join(tmp_dir, f"{exp}.json"), "w", encoding="utf-8") as fh:
            json.dump(rec, fh, indent=2, ensure_ascii=False)
    return tmp_dir


def _records(spark, d):
    return files.read_run_records(spark, os.path.join(d, "*.json"))


def test_scan_keeps_map_and_unicode(spark, records_dir):
    recs = _records(spark, records_dir)
    assert recs.count() == 4
    row = recs.filter("experiment_id = '1dn_base'").select("steps", F.map_keys("steps").alias("keys")).first()
    assert row.keys == STEP_NAMES  # file order, which step positions rely on
    assert row.steps["чтение"] == 5.77


def test_published_speedups(spark, records_dir):
    totals = _records(spark, records_dir).select(
        F.col("experiment_id").alias("config"), F.col("total_time_sec").alias("total_secs"))
    got = {r.pair: round(r.speedup, 4) for r in runlog.speedups(totals, tables.speedup_pairs(spark)).collect()}
    assert got == {
        "1DN опт. vs базовый": 1.3656,
        "3DN опт. vs базовый": 0.8266,
        "3DN базовый vs 1DN базовый": 1.5235,
    }


def test_speedup_zero_or_missing_denominator_is_null(spark):
    totals = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "config string, total_secs double")
    pairs = tables.speedup_pairs(spark, [("p1", "a", "b"), ("p2", "a", "zz")])
    got = {r.pair: r.speedup for r in runlog.speedups(totals, pairs).collect()}
    assert got == {"p1": None, "p2": None}


def test_record_summary_gives_the_published_growth(spark, records_dir):
    got = {r.experiment_id: (r.ram_delta_mb, r.n_steps)
           for r in runlog.record_summary(_records(spark, records_dir)).collect()}
    assert got["1dn_base"] == (0.1, 4)  # as stored: taken before 26.8 and 27.0 were rounded
    assert got["3dn_base"] == (0.2, 4)


def test_long_table_custom_order_and_offsets(spark, records_dir):
    long = runlog.steps_long(_records(spark, records_dir))
    ordered = runlog.with_custom_order(long).orderBy("sort_key", "step_pos")
    assert [r.run_id for r in ordered.select("run_id").distinct().orderBy(
        runlog.list_position("run_id", C.RUN_ORDER)).collect()] == C.RUN_ORDER
    offs = {(r.run_id, r.step): r.offset for r in runlog.stack_offsets(long).collect()}
    assert offs[("1dn_base", "чтение")] == 0.0
    assert offs[("1dn_base", "пропуски")] == 5.77
    assert offs[("1dn_base", "фильтрация")] == 7.17


def test_unknown_id_sorts_last_and_is_reported(spark):
    runs = spark.createDataFrame([("x", "new_cfg"), ("y", "1dn_opt")], "run_id string, config string")
    ordered = runlog.with_custom_order(runs).orderBy("sort_key").collect()
    assert [(r.run_id, r.sort_key) for r in ordered] == [("y", 2), ("x", 99)]
    enriched = {r.run_id: r.label for r in runlog.enrich(runs).collect()}
    assert enriched == {"x": None, "y": "1DN Оптимизир."}
    assert [r.run_id for r in runlog.unknown_configs(runs).collect()] == ["x"]
    # A supplied lookup works the same, without a forced broadcast.
    meta = tables.run_meta(spark)
    assert {r.run_id: r.label for r in runlog.enrich(runs, meta).collect()} == enriched
    assert "strategy=broadcast" not in runlog.enrich(runs, meta)._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(LookupError, match="new_cfg"):
        runlog.enrich(runs, strict=True)
    assert runlog.enrich(runs.where("run_id = 'y'"), strict=True).count() == 1


def test_pivot_missing_step_is_zero(spark):
    log = spark.createDataFrame(
        [("r1", "c", "a", 1, 1.5), ("r1", "c", "b", 2, 2.0), ("r2", "c", "a", 1, 3.0)],
        "run_id string, config string, step string, step_pos int, secs double")
    got = {r.run_id: (r.a, r.b) for r in runlog.step_pivot(log, ["a", "b"]).collect()}
    assert got == {"r1": (1.5, 2.0), "r2": (3.0, 0.0)}


def test_visible_steps_threshold(spark, records_dir):
    long = runlog.steps_long(_records(spark, records_dir))
    assert runlog.visible_steps(long).count() == 16
    assert runlog.visible_steps(long, 0.5).count() == 12


def test_event_run_log_goldens(spark):
    log = tables.run_log(spark, SF01)
    assert log.count() == 750
    totals = {r.config: r.total_secs for r in runlog.config_totals(log).collect()}
    assert totals == {"1dn_base": 99798.42, "1dn_opt": 96792.04, "3dn_base": 98221.48,
                      "3dn_opt": 102738.65, "zzz": 98755.98}
    offs = {r.step: r.offset for r in runlog.stack_offsets(log).filter("run_id = 'U0'").collect()}
    assert offs == {"view": 0.0, "click": 490.26, "signup": 1077.64, "purchase": 1391.08, "error": 1808.86}
    sp = {r.other_config: round(r.speedup, 4) for r in runlog.speedups(
        runlog.config_totals(log), tables.speedup_pairs(spark)).collect()}
    assert sp == {"1dn_opt": 1.0311, "3dn_opt": 0.956, "3dn_base": 1.0161}


def test_records_roundtrip_and_dynamic_overwrite(spark, tmp_dir):
    log = tables.run_log(spark, SF01)
    recs = runlog.records_from_log(log)
    out = os.path.join(tmp_dir, "records")
    files.write_run_records(recs, out)
    back = files.read_run_records(spark, out, multi_line=False)
    assert back.count() == 150
    assert back.filter(F.col("timestamp").isNull()).count() == 0
    # Re-writing one id replaces only that id.
    files.write_run_records(recs.filter("experiment_id = 'U0'").withColumn("total_time_sec", F.lit(1.0)), out)
    back = files.read_run_records(spark, out, multi_line=False)
    assert back.count() == 150
    assert back.filter("experiment_id = 'U0'").first().total_time_sec == 1.0


def test_first_record_steps_drive_the_pivot(spark, tmp_dir):
    rows = [("3dn_opt", {"a": 1.0, "late": 9.0}), ("1dn_base", {"b": 2.0, "a": 3.0})]
    for exp, steps in rows:
        with open(os.path.join(tmp_dir, f"{exp}.json"), "w", encoding="utf-8") as fh:
            json.dump({"experiment_id": exp, "total_time_sec": 1.0, "steps": steps}, fh, indent=2)
    recs = _records(spark, tmp_dir)
    steps = runlog.first_record_steps(recs)
    assert steps == ["b", "a"]  # 1dn_base comes first; "late" is dropped like the chart does
    pivot = runlog.step_pivot(runlog.steps_long(recs), steps)
    got = {r.run_id: (r.b, r.a) for r in pivot.collect()}
    assert got == {"1dn_base": (2.0, 3.0), "3dn_opt": (0.0, 1.0)}


def test_records_from_raw_log_sum_repeated_steps(spark):
    log = spark.createDataFrame(
        [("r", "c", "a", 1, 0.1), ("r", "c", "a", 1, 0.2), ("r", "c", "b", 2, 1.0)],
        "run_id string, config string, step string, step_pos int, secs double")
    rec = runlog.records_from_log(log, pre_aggregated=False).first()
    assert rec.steps == {"a": 0.3, "b": 1.0} and rec.total_time_sec == 1.3


def test_offsets_of_raw_log_aggregate_first(spark):
    log = spark.createDataFrame(
        [("r", "c", "a", 1, 0.1), ("r", "c", "a", 1, 0.2), ("r", "c", "b", 2, 1.0)],
        "run_id string, config string, step string, step_pos int, secs double")
    got = {r.step: (r.secs, r.offset) for r in runlog.stack_offsets(log, pre_aggregated=False).collect()}
    assert got == {"a": (0.3, 0.0), "b": (1.0, 0.3)}


def test_inline_run_records_keep_step_order(spark, tmp_dir):
    recs = tables.run_records(spark, [
        {"experiment_id": "a", "total_time_sec": 1.0, "steps": {"z": 1.0, "b": 2.0, "y": 3.0}},
        {"experiment_id": "b", "total_time_sec": 2, "steps": {}},
    ])
    out = os.path.join(tmp_dir, "recs")
    files.write_run_records(recs, out)
    back = files.read_run_records(spark, out, multi_line=False)
    keys = {r.experiment_id: r.k for r in back.select("experiment_id", F.map_keys("steps").alias("k")).collect()}
    assert keys == {"a": ["z", "b", "y"], "b": []}


def test_analysis_app_on_published_records(spark, records_dir, capsys):
    from ledgerlens.plans import analysis
    t = analysis.main(["--records", os.path.join(records_dir, "*.json")], spark=spark)
    runs = [(r.experiment_id, r.label, r.shuffle, r.repartition) for r in t["runs"].collect()]
    assert runs == [("1dn_base", "1DN Базовый", 4, None), ("1dn_opt", "1DN Оптимизир.", 8, 8),
                    ("3dn_base", "3DN Базовый", 4, None), ("3dn_opt", "3DN Оптимизир.", 8, 8)]
    assert t["step_table"].columns == ["run_id"] + STEP_NAMES
    assert [tuple(r)[1:] for r in t["step_table"].collect()] == [tuple(p[5]) for p in PUBLISHED]
    assert {r.pair: round(r.speedup, 2) for r in t["speedups"].collect()} == {
        "1DN опт. vs базовый": 1.37, "3DN опт. vs базовый": 0.83, "3DN базовый vs 1DN базовый": 1.52}
    assert t["labelled_steps"].count() == 16
    assert "speedups" in capsys.readouterr().out


def test_latest_record_per_id_wins(spark, tmp_dir):
    recs = tables.run_records(spark, [
        {"experiment_id": "a", "total_time_sec": 1.0, "steps": {"s": 1.0}, "timestamp": "2026-01-01 10:00:00"},
        {"experiment_id": "a", "total_time_sec": 2.0, "steps": {"s": 2.0}, "timestamp": "2026-01-02 10:00:00"},
        {"experiment_id": "b", "total_time_sec": 3.0, "steps": {"s": 3.0}, "timestamp": "2026-01-01 09:00:00"},
    ])
    out = os.path.join(tmp_dir, "recs")
    files.write_run_records(recs, out)
    back = {r.experiment_id: r.total_time_sec for r in files.read_run_records(spark, out, multi_line=False).collect()}
    assert back == {"a": 2.0, "b": 3.0}


def test_equal_timestamps_keep_the_longest_record(spark, tmp_dir):
    rows = [{"experiment_id": "a", "total_time_sec": t, "steps": {"s": t}, "timestamp": "2026-01-01 10:00:00"} for t in (1.0, 3.0, 2.0)]
    for order in (rows, rows[::-1]):
        out = os.path.join(tmp_dir, f"recs{order[0]['total_time_sec']}")
        files.write_run_records(tables.run_records(spark, order).repartition(3), out)
        assert [r.total_time_sec for r in files.read_run_records(spark, out, multi_line=False).collect()] == [3.0]


def test_merge_keeps_the_other_records_of_a_bucket(spark, tmp_dir):
    def records(ids, secs):
        return tables.run_records(spark, [{"experiment_id": i, "total_time_sec": secs, "steps": {"чтение": secs}} for i in ids])
    files.write_run_records(records([f"r{i}" for i in range(40)], 1.0), tmp_dir + "/x", buckets=3)
    files.write_run_records(records(["r3", "new"], 2.0), tmp_dir + "/x", buckets=3)
    got = {r.experiment_id: (r.total_time_sec, r.steps) for r in files.read_run_records(spark, tmp_dir + "/x", multi_line=False).collect()}
    assert len(got) == 41 and got["r3"] == (2.0, {"чтение": 2.0}) and got["new"][0] == 2.0 and got["r4"][0] == 1.0


def test_the_stored_ram_delta_comes_first(spark):
    records = tables.run_records(spark, [
        {"experiment_id": "1dn_base", "ram_start_mb": 26.8, "ram_end_mb": 27.0, "ram_delta_mb": 0.1, "steps": {}},
        {"experiment_id": "3dn_base", "ram_start_mb": 27.0, "ram_end_mb": 27.2, "ram_delta_mb": 0.2, "steps": {}},
        {"experiment_id": "old", "ram_start_mb": 26.8, "ram_end_mb": 27.0, "steps": {}}])
    assert {r.experiment_id: r.ram_delta_mb for r in runlog.record_summary(records).collect()} == {"1dn_base": 0.1, "3dn_base": 0.2, "old": 0.2}


def test_default_pivot_has_all_steps_by_first_position(spark):
    log = spark.createDataFrame([("r1", "c", "b", 1, 1.0), ("r2", "c", "late", 7, 2.0), ("r2", "c", "a", 1, 2.0)],
                                "run_id string, config string, step string, step_pos int, secs double")
    assert runlog.step_pivot(log).columns == ["run_id", "a", "b", "late"]


def test_pivot_without_steps_lists_runs(spark):
    log = spark.createDataFrame([("r1", "c", "a", 1, 1.0), ("r1", "c", "b", 2, 2.0)],
                                "run_id string, config string, step string, step_pos int, secs double")
    assert [tuple(r) for r in runlog.step_pivot(log, []).collect()] == [("r1",)]


# --- offsets of runs that span partitions -------------------------------------------

def test_long_offsets_equal_the_window(spark):
    """One run with most of the rows, short runs, a null run, equal positions, missing seconds."""
    n = 20000
    log = spark.range(n).select(
        F.when(F.col("id") % 50 == 0, F.concat(F.lit("r"), (F.col("id") % 7).cast("string")))
        .when(F.col("id") % 50 == 1, F.lit(None).cast("string")).otherwise("long").alias("run_id"),
        F.lit("c").alias("config"), F.format_string("s%07d", F.col("id")).alias("step"),
        (F.pmod(F.xxhash64("id"), F.lit(n // 4))).cast("int").alias("step_pos"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**6)) / 1000.0).alias("secs"))
    for pre_aggregated, rows in ((True, log), (False, log.unionByName(log.where("step_pos % 3 = 0")))):
        got = runlog.long_offsets(rows, partitions=8, pre_aggregated=pre_aggregated)
        want = runlog.stack_offsets(rows, pre_aggregated=pre_aggregated)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_long_offsets_hold_no_run_in_one_task(spark):
    log = spark.range(40000).select(
        F.lit("one").alias("run_id"), F.lit("c").alias("config"), F.col("id").cast("string").alias("step"),
        F.col("id").cast("int").alias("step_pos"), (F.col("id") % 100 / 100).alias("secs"))
    out = runlog.long_offsets(log, partitions=8, pre_aggregated=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("Window [")[1]  # the window over steps is per part
    cents = sum(i % 100 for i in range(39999))
    assert out.where("step_pos = 39999").first().offset == cents / 100
    assert out.count() == 40000


def test_long_offsets_of_no_rows(spark):
    log = spark.createDataFrame([], "run_id string, config string, step string, step_pos int, secs double")
    assert runlog.long_offsets(log).count() == 0


# --- pivot over many step names ----------------------------------------------------

def test_step_blocks_equal_the_pivot(spark):
    rows = [(f"r{r}", "c", f"s{s:02d}", s % 5, (r * 31 + s * 7) / 100) for r in range(6) for s in range(23) if (r * s) % 4 != 1]
    rows += [("r0", "c", "s01", 1, 0.5), ("r0", "c", None, 1, 9.0), ("r1", "c", "s02", None, None), (None, "c", "s03", 2, 1.0)]
    log = spark.createDataFrame(rows, "run_id string, config string, step string, step_pos int, secs double")
    dictionary = runlog.step_dictionary(log, 4, partitions=3)
    names = [r.step for r in dictionary.orderBy("place").collect()]
    assert names == runlog.all_steps(log)
    assert all(r.block == r.place // 4 and r.slot == r.place % 4 for r in dictionary.collect())
    blocks = runlog.step_blocks(log, dictionary, 4)
    pivot = {r.run_id: r.asDict() for r in runlog.step_pivot(log.where("step IS NOT NULL")).collect()}
    got = {}
    for b in range(6):
        table = runlog.block_table(blocks, dictionary, b)
        assert table.columns == ["run_id", *names[b * 4:b * 4 + 4]]
        for r in table.collect():
            got.setdefault(r.run_id, {}).update(r.asDict())
    assert {run: {s: cells.get(s, 0.0) for s in names} for run, cells in got.items()} == {
        run: {s: cells[s] for s in names} for run, cells in pivot.items()}


def test_a_hundred_thousand_step_names(spark):
    n, width = 100_000, 500
    log = spark.range(2 * n).select(
        F.when(F.col("id") < n, "long").otherwise(F.concat(F.lit("r"), (F.col("id") % 50).cast("string"))).alias("run_id"),
        F.lit("c").alias("config"), F.format_string("s%06d", F.col("id") % n).alias("step"),
        (F.col("id") % n).cast("int").alias("step_pos"), F.lit(0.25).alias("secs"))
    with pytest.raises(ValueError, match="step_blocks"):
        runlog.all_steps(log)
    dictionary = runlog.step_dictionary(log, width)
    blocks = runlog.step_blocks(log, dictionary, width)
    sizes = blocks.agg(F.count(F.lit(1)), F.max(F.size("secs")), F.sum(F.aggregate("secs", F.lit(0.0), lambda a, b: a + b))).first()
    assert tuple(sizes) == (n // width * 51, width, 2 * n * 0.25)
    first = runlog.block_table(blocks, dictionary, 199)
    assert first.columns[1:] == [f"s{i:06d}" for i in range(199 * width, n)]
    assert first.where("run_id = 'long'").first()["s099999"] == 0.25


def test_step_blocks_of_no_rows(spark):
    log = spark.createDataFrame([], "run_id string, config string, step string, step_pos int, secs double")
    assert runlog.step_blocks(log, runlog.step_dictionary(log)).count() == 0
