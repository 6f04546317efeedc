"""Every registered query against its DuckDB oracle on the smallest driver
tables (row count, column names, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from auric.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    no_sql = sorted(set(QUERIES) - set(SQL))
    assert [q for q in no_sql if not q.startswith(("op", "pipeline"))] == []


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "pessoas_ativas" in df.columns
