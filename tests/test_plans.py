import __spark_entry__ as E
from ledgerlens.plans import (
    TunedReports, base_reports, order_stats, reports_from_stats, single_pass_reports, tuned_reports,
)
from ledgerlens.plans.tuned import estimated_bytes, free_storage_bytes, pruned, sharing
from ledgerlens.sources import tables

from .conftest import SF01

T = 30000.0


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _persistent_rdds(spark):
    return spark.sparkContext._jsc.getPersistentRDDs().size()


def test_base_tuned_and_single_pass_agree(spark):
    ol = tables.order_lines(spark, SF01)
    base = base_reports(ol, T)
    summary, express = tuned_reports(ol, T, repartition=3)
    count, sp_summary, sp_express = single_pass_reports(ol, T)
    assert _rows(base.category_summary) == _rows(summary) == _rows(sp_summary)
    assert _rows(base.express_by_region) == _rows(express) == _rows(sp_express)
    assert base.row_count.first().row_count == count.first().row_count == 60000


def test_tuned_releases_its_cache(spark):
    before = _persistent_rdds(spark)
    ol = tables.order_lines(spark, SF01)
    with TunedReports(ol, T, repartition=4) as t:
        t.category_summary.collect()
        t.express_by_region.collect()
        assert _persistent_rdds(spark) == before + 1
        cached = t.shared._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in cached
    assert _persistent_rdds(spark) == before


def test_tuned_cache_holds_only_report_columns(spark):
    ol = tables.order_lines(spark, SF01)
    with TunedReports(ol, T) as t:
        plan = t.shared._jdf.queryExecution().executedPlan().toString()
    assert "l_tax" not in plan and "l_shipdate" not in plan


def test_single_pass_scans_lineitem_once(spark):
    ol = tables.order_lines(spark, SF01)
    stats = order_stats(ol, T)
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1, plan
    count, summary, express = reports_from_stats(stats.checkpoint(eager=True))
    for report in (count, summary, express):
        assert "Scan parquet" not in report._jdf.queryExecution().executedPlan().toString()


def test_single_pass_handles_all_missing_ratings(spark):
    df = spark.createDataFrame(
        [("o1", "A", 1, "R", True, None, 10.0), ("o2", "A", 3, "R", False, None, 20.0)],
        "order_id string, product_category string, quantity int, delivery_region string, "
        "is_express boolean, customer_rating double, total_amount double")
    _, summary, express = single_pass_reports(df, 5.0)
    base = base_reports(df, 5.0)
    assert _rows(summary) == _rows(base.category_summary) == [("A", 2, 30.0, None, 2.0)]
    assert _rows(express) == _rows(base.express_by_region) == [("R", 1, 10.0)]


def test_registered_tuned_queries_share_deal_out_and_release(spark, monkeypatch):
    """The frames that the registered queries run read one cached, repartitioned input."""
    plans, before = [], _persistent_rdds(spark)
    frame = type(spark.range(1))
    checkpoint = frame.checkpoint

    def seen(df, eager=True):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        assert _persistent_rdds(spark) <= before + 1
        return checkpoint(df, eager)

    monkeypatch.setattr(frame, "checkpoint", seen)
    for name in ("tuned_category_summary", "tuned_express_by_region"):
        plans.clear()
        got = E.queries()[name](spark, SF01)
        assert len(plans) == 2  # both reports
        for plan in plans:
            assert "InMemoryTableScan" in plan and "InMemoryRelation" in plan, plan
            assert "RoundRobinPartitioning" in plan, plan
        assert _persistent_rdds(spark) == before
        assert _rows(got) == _rows(E.queries()[name.removeprefix("tuned_")](spark, SF01))


def test_sharing_follows_the_sizes(spark):
    ol = pruned(tables.order_lines(spark, SF01), ("category_summary", "express_by_region"))
    size = estimated_bytes(ol)
    fits = sharing(ol, partition_bytes=size // 4, free_bytes=100 * size)
    assert fits.persist and 4 <= fits.partitions <= 5
    assert sharing(ol, partition_bytes=size, free_bytes=100 * size).partitions is None  # one partition is right
    tight = sharing(ol, partition_bytes=size // 4, free_bytes=size)
    assert not tight.persist and tight.partitions is None
    assert free_storage_bytes(spark) > 0
    before = _persistent_rdds(spark)
    with TunedReports(tables.order_lines(spark, SF01), T, reports=("category_summary", "express_by_region"), rule=tight) as t:
        rows = _rows(t.category_summary)
        assert _persistent_rdds(spark) == before  # each report scans the source
    assert rows == _rows(base_reports(tables.order_lines(spark, SF01), T).category_summary)
    summary, _ = tuned_reports(tables.order_lines(spark, SF01), T, free_bytes=1)
    assert _rows(summary) == rows


def test_a_single_file_split_is_dealt_out_from_its_bytes(spark, tmp_dir):
    path = tmp_dir + "/many"
    tables.order_lines(spark, SF01).repartition(40).write.parquet(path)
    many = spark.read.parquet(path)
    rule = sharing(many, partition_bytes=1 << 30, free_bytes=1 << 40)
    assert rule.persist and (rule.partitions == 1 or many._jdf.toJavaRDD().getNumPartitions() <= 2)
