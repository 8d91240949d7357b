"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime
from functools import lru_cache
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = Path(os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001"))
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


# Finds nothing in the smallest tables.
LARGER = {name: SF_DIR.with_name("sf0.01") for name in ("chain_exists_selfjoin", "decreasing_chain_defaults")}


@lru_cache
def duck(sf_dir: Path) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sf_dir.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def shown(value: object) -> object:
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(shown(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    sf_dir = LARGER.get(name, SF_DIR)
    result = QUERIES[name](spark, str(sf_dir))
    cursor = duck(sf_dir).execute(SQL[name])
    columns = [item[0] for item in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = bag(columns, cursor.fetchall())
    assert expected, "the SQL finds nothing, so it checks nothing"
    assert bag(result.columns, result.collect()) == expected


def test_every_query_of_the_catalogue_has_its_sql():
    from vaultline.plans.catalogue import CATALOGUE

    assert set(CATALOGUE) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "event_dt", "passport", "fio", "phone", "event_type", "report_dt",
    ]
