"""Every registered query against its SQL, on the smallest provided tables."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from tablekeeper.plans import registry

SF = "/root/testdata/sf0.001"
NO_SQL = {"scan_files"}
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    rows = df.collect()
    if name in NO_SQL:
        assert rows
        return
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert check.rows_of(df.columns, rows) == check.rows_of(names, cur.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(NAMES) <= set(queries())
    assert set(NAMES) - set(oracle_sql()) == NO_SQL
