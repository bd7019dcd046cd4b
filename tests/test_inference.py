import os
import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources import files, inference, tables

from .conftest import SF001

COLUMNS = {
    "i": ["1", "-7", ""], "l": ["1", "3000000000", ""], "x": ["1", "2.5", "1e3"], "big": ["1", "123456789012345678901234", ""],
    "ts": ["2024-01-01 10:00:00", "", "2024-02-29 00:00:00"], "b": ["True", "false", ""], "s": ["a", "1", "true"],
    "nothing": ["", "", ""], "wide": ["3000000000", "1.5", "7"], "d": ["2024-01-01", "2024-02-29", ""],
    "bad": ["2024-02-30 10:00:00", "", ""], "odd`name.x": ["1", "2", "3"],
}


def _write(path, columns):
    with open(path, "w") as out:
        out.write(",".join(columns) + "\n")
        for row in zip(*columns.values()):
            out.write(",".join(row) + "\n")


def _spark_types(spark, path):
    """The session's own inference, with wall-clock timestamps."""
    schema = (spark.read.option("header", True).option("inferSchema", True)
              .option("timestampFormat", files.TIMESTAMP_FORMAT).csv(path).schema)
    return [T.TimestampNTZType() if f.dataType == T.TimestampType() else f.dataType for f in schema]


def test_types_equal_the_sessions_inference(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    _write(path, COLUMNS)
    got = inference.read_csv_once(spark, path)
    assert [f.dataType for f in got.rows.schema] == _spark_types(spark, path)
    assert got.rows.columns == list(COLUMNS)
    assert got.rows.where("s = 'a'").first().big == 1 and got.rows.where("s = 'true'").first().x == 1000.0
    assert got.mixed == {"s": ["int", "boolean", "string"]}


def test_order_lines_come_back_whole(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    lines = tables.order_lines(spark, SF001)
    files.write_csv(lines, path)
    got = inference.read_csv_once(spark, path)
    assert [f.dataType for f in got.rows.schema] == [f.dataType for f in lines.schema]
    assert sorted(map(tuple, got.rows.collect())) == sorted(map(tuple, lines.collect()))


def test_the_text_is_not_read_again(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t.csv")
    _write(path, COLUMNS)
    got = inference.read_csv_once(spark, path)
    os.remove(path)
    assert got.rows.count() == 3 and got.conflicts().count() == 3
    assert "FileScan parquet" in got.rows._jdf.queryExecution().toString()


def test_conflicts_name_files_and_kinds(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "parts")
    os.mkdir(folder)
    _write(os.path.join(folder, "a.csv"), {"id": ["1", "2"], "v": ["5", "6"]})
    _write(os.path.join(folder, "b.csv"), {"id": ["3", "4"], "v": ["7", "n/a"]})
    got = inference.read_csv_once(spark, folder)
    assert got.rows.schema["id"].dataType == T.IntegerType() and got.rows.schema["v"].dataType == T.StringType()
    assert {(os.path.basename(r.file), r.column, r.kind, r.n_fields) for r in got.conflicts().collect()} == {
        ("a.csv", "v", "int", 2), ("b.csv", "v", "int", 1), ("b.csv", "v", "string", 1)}
    _write(os.path.join(folder, "c.csv"), {"v": ["5"], "id": ["6"]})
    with pytest.raises(Exception, match="(?i)header"):
        inference.read_csv_once(spark, folder)


def test_header_only_and_clashing_names(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    _write(path, {"_file": [], "x": []})
    got = inference.read_csv_once(spark, path)
    assert [f.dataType for f in got.rows.schema] == [T.StringType()] * 2 and got.rows.count() == 0
    assert got.conflicts().count() == 0


def _plain_kind(field):
    """The kinds as they are defined: the first cast that holds."""
    whole = field.rlike(r"^[+-]?[0-9]+$")
    return (
        F.when(field.isNull(), None)
        .when(whole & field.try_cast("int").isNotNull(), "int")
        .when(whole & field.try_cast("bigint").isNotNull(), "bigint")
        .when(whole & (F.length(F.regexp_replace(field, "^[+-]?0*", "")) <= 38), "decimal")
        .when(field.try_cast("double").isNotNull(), "double")
        .when(field.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & field.try_cast("date").isNotNull(), "date")
        .when(field.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
              & field.try_cast("timestamp_ntz").isNotNull(), "timestamp_ntz")
        .when(F.lower(field).isin("true", "false"), "boolean")
        .otherwise("string")
    )


def test_kinds_are_those_of_the_casts(spark):
    parts = ["", " ", "+", "-", "0", "7", "12", "2147483647", "2147483648", "9223372036854775807", "9223372036854775808", "9" * 38,
             ".", "e5", "E-3", "1.5", "f", "d", "D", "NaN", "nan", "inf", "Infinity", "iNFinity", "0x1p3", "0x", "\n", "\r\n", "\u2028", "\u0085",
             "2024-01-01", "2024-02-30", "2024-13-01", "0000-01-01", " 10:00:00", " 24:00:00", " 23:59:60", "true", "False", "a", "\x00", "é", "١"]
    rng = random.Random(7)
    texts = {*parts, *(a + b for a in parts for b in parts)} | {"".join(rng.choice(parts) for _ in range(3)) for _ in range(3000)}
    texts |= {"".join(rng.choice("0123456789+-.eEfdxp :nN\n") for _ in range(rng.randint(1, 7))) for _ in range(4000)}
    field = F.col("value")
    rows = spark.createDataFrame([(t,) for t in sorted(texts)] + [(None,)], "value string")
    rows = rows.select("value", inference.kind_of(field).alias("got"), _plain_kind(field).alias("want"))
    assert [tuple(r) for r in rows.collect() if r.got != r.want] == []


def test_text_costs_little_more_than_numbers(spark, tmp_dir):
    # a cast that fails costs an exception: words and dates took many times as long as numbers
    def seconds(kind, column):
        path = os.path.join(tmp_dir, kind)
        spark.range(0, 400_000, 1, 4).select(*(F.expr(column).alias(f"c{i}") for i in range(4))).write.option("header", True).csv(path)
        taken = []
        for _ in range(3):
            began = time.perf_counter()
            inference.read_csv_once(spark, path)
            taken.append(time.perf_counter() - began)
        return min(taken)

    numbers = seconds("numbers", "cast(id as string)")
    assert seconds("words", "concat('ORD-', id)") < 2.5 * numbers
    assert seconds("dates", "concat('2024-01-', lpad(1 + id % 28, 2, '0'))") < 2.5 * numbers


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 255), min_size=1, max_size=6), st.randoms())
def test_the_lattice_merges_in_any_order(masks, random):
    whole = 0
    for mask in masks:
        whole |= mask
    random.shuffle(masks)
    left = right = 0
    for i, mask in enumerate(masks):
        left, right = (left | mask, right) if i % 2 else (left, right | mask)
    assert inference.type_of(left | right, 20) == inference.type_of(whole, 20)
