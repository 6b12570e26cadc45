"""The registered queries against their SQL, and that each reads its whole table."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from sluice.llm.oracle import ORACLE
from sluice.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def test_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(QUERIES)
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE[name])
    names = sorted(c[0] for c in expected.description)
    assert sorted(result.columns) == names
    at = [[c[0] for c in expected.description].index(n) for n in names]
    want = Counter(tuple(row[i] for i in at) for row in expected.fetchall())
    have = Counter(tuple(row[n] for n in names) for row in result.collect())
    assert sum(want.values()) > 0
    assert have == want
