"""Every registered query against its DuckDB oracle at sf0.001 (the driver runs sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest, type_mismatches

from .conftest import SF001

QUERIES = E._order_queries()
SQL = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


def test_every_oracle_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert type_mismatches(df.schema, cur.description) == []
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["product_category", "total_orders", "revenue", "avg_rating", "avg_quantity"]
    assert out.count() > 0


def test_the_oracle_sees_sums_that_drop_fractions_of_cents(spark):
    """Plain decimal sums over 1000 amounts of 0.004: a cent-rounded sum would be 0."""
    from ledgerlens.operators.summaries import money_sum_by
    from tools.oracle_sql import money
    df = spark.range(1000).selectExpr("'k' AS k", "0.004D AS x")
    want = duckdb.sql(f"SELECT {money('x')} AS s FROM (SELECT CAST(0.004 AS DOUBLE) AS x FROM range(1000))").fetchall()[0][0]
    assert want == 4.0 == money_sum_by(df, "k", "x", "s").first().s
    cent_rounded = df.selectExpr("sum(cast(rint(x * 100) as bigint)) / 100.0D AS s").first().s
    assert cent_rounded != want


def test_the_oracle_imports_nothing_from_the_library():
    import tools.oracle_sql as sql
    assert "import ledgerlens" not in open(sql.__file__).read() and "from ledgerlens" not in open(sql.__file__).read()
