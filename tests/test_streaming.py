import os

from pyspark.sql import functions as F

from ledgerlens.plans import base_reports
from ledgerlens.sources import tables
from ledgerlens.streaming import latest_report, start_order_reports

from .conftest import SF001


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_stream_reports_equal_batch_reports_after_each_arrival(spark, tmp_dir):
    lines = tables.order_lines(spark, SF001)
    landing, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "reports")
    ckpt = os.path.join(tmp_dir, "ckpt")
    seen = None
    for part in range(3):
        chunk = lines.filter(F.pmod(F.hash("order_id", "total_amount"), F.lit(3)) == part)
        chunk.write.mode("append").parquet(landing)
        seen = chunk if seen is None else seen.unionByName(chunk)
        q = start_order_reports(spark, landing, out, 30000.0, checkpoint_location=ckpt, available_now=True)
        q.awaitTermination(120)
        expected = base_reports(seen, 30000.0)
        assert _rows(latest_report(spark, out, "category_summary").orderBy(
            F.col("revenue").desc(), "product_category")) == _rows(expected.category_summary)
        assert _rows(latest_report(spark, out, "express_by_region").orderBy(
            F.col("express_revenue").desc(), "delivery_region")) == _rows(expected.express_by_region)
        assert latest_report(spark, out, "row_count").first().row_count == expected.row_count.first().row_count
    assert seen.count() == lines.count()


def test_stream_over_csv_landing_folder(spark, tmp_dir):
    from ledgerlens.sources import files
    lines = tables.order_lines(spark, SF001)
    landing, out = os.path.join(tmp_dir, "csv-landing"), os.path.join(tmp_dir, "csv-reports")
    files.write_csv(lines, landing)
    q = start_order_reports(spark, landing, out, 30000.0, available_now=True, fmt="csv",
                            checkpoint_location=os.path.join(tmp_dir, "csv-ckpt"))
    q.awaitTermination(120)
    expected = base_reports(lines, 30000.0)
    assert _rows(latest_report(spark, out, "category_summary").orderBy(
        F.col("revenue").desc(), "product_category")) == _rows(expected.category_summary)


def test_an_epoch_without_its_marker_is_not_read(spark, tmp_dir):
    spark.createDataFrame([(3,)], "row_count long").write.parquet(f"{tmp_dir}/epoch-0/row_count")
    spark.createDataFrame([(0,)], "epoch long").write.parquet(f"{tmp_dir}/complete")
    spark.createDataFrame([(9,)], "row_count long").write.parquet(f"{tmp_dir}/epoch-1/row_count")  # cut off here
    assert latest_report(spark, tmp_dir, "row_count").first().row_count == 3
