import os

from pyspark.sql import functions as F

from ledgerlens import constants as C
from ledgerlens.plans import analysis, app
from ledgerlens.sources import files, tables

from .conftest import SF001


def test_job_plans_write_records_and_analysis_reads_them(spark, tmp_dir, capsys):
    csv = os.path.join(tmp_dir, "orders")
    files.write_csv(tables.order_lines(spark, SF001), csv)
    results, out = os.path.join(tmp_dir, "results"), os.path.join(tmp_dir, "reports")
    runs = [("1dn_base", "base"), ("1dn_opt", "tuned"), ("3dn_base", "single-pass"), ("3dn_opt", "base")]
    for exp, plan in runs:
        args = ["--input", csv, "--results-dir", results, "--experiment-id", exp, "--plan", plan,
                "--threshold", "30000", "--output", os.path.join(out, exp)]
        if plan == "tuned":
            args += ["--repartition", "4"]
        record = app.main(args, spark=spark)
        assert list(record["steps"]) == C.RUN_STEP_NAMES
    printed = capsys.readouterr().out
    assert "category summary" in printed and "express by region" in printed

    # Every plan wrote the same reports.
    summaries = [sorted(map(tuple, spark.read.parquet(os.path.join(out, e, "category_summary")).collect()))
                 for e, _ in runs]
    assert all(s == summaries[0] for s in summaries)

    # Re-running an id replaces its record only.
    app.main(["--input", csv, "--results-dir", results, "--experiment-id", "1dn_base"], spark=spark)
    records = files.read_run_records(spark, results)
    assert records.count() == 4

    t = analysis.main(["--records", results], spark=spark)
    assert [r.experiment_id for r in t["runs"].collect()] == ["1dn_base", "1dn_opt", "3dn_base", "3dn_opt"]
    assert t["step_table"].columns == ["run_id", *C.RUN_STEP_NAMES]
    assert t["speedups"].filter(F.col("speedup").isNull()).count() == 0
    assert t["unknown_configs"].count() == 0


def test_dataset_app_generates_profiles_and_feeds_the_job(spark, tmp_dir):
    from ledgerlens.plans import dataset
    path = os.path.join(tmp_dir, "orders.csv")
    info = dataset.main(["--rows", "5000", "--output", path, "--partitions", "3"], spark=spark)
    assert (info["n_rows"], info["n_cols"]) == (5000, 9)
    assert 0 < info["nulls"]["customer_rating"] < 500
    assert sum(info["nulls"].values()) == info["nulls"]["customer_rating"]
    record = app.main(["--input", path, "--results-dir", os.path.join(tmp_dir, "r")], spark=spark)
    assert record["experiment_id"] == "1dn_base"


def test_app_reads_typed_csv_and_parquet_alike(spark, tmp_dir):
    lines = tables.order_lines(spark, SF001)
    csv, pq = os.path.join(tmp_dir, "csv"), os.path.join(tmp_dir, "pq")
    files.write_csv(lines, csv)
    files.write_parquet(lines, pq)
    outs = []
    for name, extra in (("typed", ["--input", csv]), ("inferred", ["--input", csv, "--infer"]),
                        ("parquet", ["--input", pq, "--format", "parquet"])):
        out = os.path.join(tmp_dir, f"out-{name}")
        app.main(extra + ["--results-dir", os.path.join(tmp_dir, "r"), "--experiment-id", name,
                          "--threshold", "30000", "--output", out], spark=spark)
        outs.append(sorted(map(tuple, spark.read.parquet(os.path.join(out, "express_by_region")).collect())))
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) == 5
    assert files.read_run_records(spark, os.path.join(tmp_dir, "r")).count() == 3


def test_step_table_has_the_steps_of_every_record(spark, tmp_dir):
    records = tables.run_records(spark, [
        {"experiment_id": "1dn_base", "total_time_sec": 1.0, "steps": {}},
        {"experiment_id": "1dn_opt", "total_time_sec": 2.0, "steps": {"a": 1.0}},
        {"experiment_id": "3dn_base", "total_time_sec": 3.0, "steps": {"a": 1.0, "b": 2.0}}])
    t = analysis.analysis_tables(spark, records)
    assert t["step_table"].columns == ["run_id", "a", "b"]
    files.write_run_records(records, os.path.join(tmp_dir, "records"))
    out = os.path.join(tmp_dir, "tables")
    t = analysis.main(["--records", os.path.join(tmp_dir, "records"), "--json-lines", "--output", out, "--show", "2"], spark=spark)
    assert sorted(os.listdir(out)) == sorted(t)
    assert spark.read.parquet(os.path.join(out, "totals")).count() == 3
