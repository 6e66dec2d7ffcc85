"""Corpus queries against their check SQL."""

from __future__ import annotations

import duckdb
import pytest

from loanscope.llm import oracle, queries
from tests.check_all import compare


def test_thirteen_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    assert compare(queries.queries()[name](spark, folder), con, oracle.oracle_sql()[name]) is None
