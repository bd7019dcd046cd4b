import datetime as dt
import os

import pytest

from ledgerlens import schemas
from ledgerlens.sources import files, tables

from .conftest import SF001


def test_csv_round_trip_typed_and_inferred(spark, tmp_dir):
    lines = tables.order_lines(spark, SF001)
    path = os.path.join(tmp_dir, "orders")
    files.write_csv(lines, path)
    expected = sorted(tuple(r) for r in lines.collect())
    typed = files.read_csv(spark, path)
    inferred = files.read_csv_inferred(spark, path)
    assert typed.schema == schemas.ORDER_LINES
    assert [f.dataType for f in inferred.schema] == [f.dataType for f in schemas.ORDER_LINES]
    assert sorted(tuple(r) for r in typed.collect()) == expected
    assert sorted(tuple(r) for r in inferred.collect()) == expected


def test_inferred_timestamps_ignore_session_zone(spark, tmp_dir):
    # Midnight of 2018-11-04 does not exist in Sao Paulo (clocks jumped to 01:00).
    path = os.path.join(tmp_dir, "ts.csv")
    with open(path, "w") as fh:
        fh.write("id,ts\n1,2018-11-04 00:00:00\n2,2024-01-01 12:30:00\n")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [r.ts for r in files.read_csv_inferred(spark, path).orderBy("id").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2018, 11, 4, 0, 0), dt.datetime(2024, 1, 1, 12, 30)]


def test_empty_field_is_null(spark, tmp_dir):
    path = os.path.join(tmp_dir, "n.csv")
    with open(path, "w") as fh:
        fh.write("order_id,customer_rating\nA,\nB,4.5\n")
    df = files.read_csv(spark, path, schema=schemas.ORDER_LINES.__class__(
        [schemas.ORDER_LINES["order_id"], schemas.ORDER_LINES["customer_rating"]]))
    assert [r.customer_rating for r in df.orderBy("order_id").collect()] == [None, 4.5]


def test_parquet_round_trip(spark, tmp_dir):
    df = tables.run_log(spark, SF001)
    path = os.path.join(tmp_dir, "log")
    files.write_parquet(df, path)
    assert sorted(map(tuple, files.read_parquet(spark, path).collect())) == sorted(map(tuple, df.collect()))


HEADER = "total_amount,order_id,is_express,delivery_region,quantity,extra,product_category,unit_price,order_date,customer_rating"


def test_columns_are_bound_by_header_name(spark, tmp_dir):
    path = os.path.join(tmp_dir, "o.csv")
    with open(path, "w") as fh:
        fh.write(HEADER + "\n30.0,A,True,R1,2,x,Books,15.0,2024-01-01 00:00:00,4.0\n")
    df = files.read_csv(spark, path)
    assert df.schema == schemas.ORDER_LINES
    row = df.first()
    assert (row.order_id, row.total_amount, row.is_express, row.delivery_region, row.customer_rating) == ("A", 30.0, True, "R1", 4.0)
    with open(path, "w") as fh:
        fh.write("order_id\nA\n")
    with pytest.raises(ValueError, match="customer_rating"):
        files.read_csv(spark, path)


def test_malformed_rows_are_refused_or_counted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "o.csv")
    with open(path, "w") as fh:
        fh.write(HEADER + "\n30.0,A,True,R1,2,x,Books,15.0,2024-01-01 00:00:00,4.0\n")
        fh.write("thirty,B,True,R1,2,x,Books,15.0,2024-01-01 00:00:00,4.0\n")
    with pytest.raises(Exception, match="MALFORMED|thirty"):
        files.read_csv(spark, path).collect()
    assert [r.total_amount for r in files.read_csv(spark, path, mode="PERMISSIVE").orderBy("order_id").collect()] == [30.0, None]
    assert files.read_csv(spark, path, mode="DROPMALFORMED").collect()[0].order_id == "A"
    assert files.malformed_rows(spark, path).first().malformed_rows == 1
