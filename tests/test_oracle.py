"""Every registered query against its SQL on the smallest driver tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, duck, name):
    cur = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    want = [dict(zip(columns, r)) for r in cur.fetchall()]
    df = entry.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert canonical([r.asDict() for r in df.collect()]) == canonical(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
