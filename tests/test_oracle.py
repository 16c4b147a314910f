"""Every query with an SQL counterpart gives the same rows on the smallest data."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    status, _, note = compare(spark, con, name, FOLDER)
    assert status == "ok", note


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 30
