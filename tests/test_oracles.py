"""Registered queries against their SQL. ``scripts/check_oracles.py`` runs all of them."""

from __future__ import annotations

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402
from blockloom.demo import oracles  # noqa: E402
from blockloom.demo import queries as registered  # noqa: E402
from scripts.check_oracles import TABLES, compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for table in TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return made


def test_every_query_of_the_tables_has_its_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
