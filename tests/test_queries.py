"""Every registered query against its check SQL, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from loanscope import registry
from oracle import queries as checks
from tests.check_all import compare, duck

QUERIES = registry.queries()
CHECKS = checks.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_check():
    assert QUERIES.keys() == CHECKS.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), con, CHECKS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5


def test_published_relations(spark, sf_dir):
    """Cohort sizes and arrears add up to the portfolio, loan counts to the records."""
    portfolio = QUERIES["mart_portfolio_performance"](spark, sf_dir).collect()
    cohorts = QUERIES["mart_cohort_analysis"](spark, sf_dir).groupBy("snapshot_date").sum(
        "cohort_size", "arrears_count"
    ).collect()
    sums = {row.snapshot_date: (row[1], row[2]) for row in cohorts}
    assert sums == {row.snapshot_date: (row.total_loans, row.arrears_count) for row in portfolio}
    records = QUERIES["agg_union_stats"](spark, sf_dir).first().total_rows
    assert sum(row.total_loans for row in portfolio) == records
