"""Every registered query against its SQL equivalent in DuckDB."""

from __future__ import annotations

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from catalog.oracle import ORACLE
from catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(comparable(row[i]) for i in order) for row in rows)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    want = bag(names, expected.fetchall())
    have = bag(result.columns, result.collect())
    assert sum(have.values()) == sum(want.values()) > 0
    assert have == want


def test_entry_runs(spark):
    assert not contract.entry(spark).isEmpty()
