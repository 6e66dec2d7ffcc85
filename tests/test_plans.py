"""Physical plans: no row multiplication by the engine, pruned scans, early top-1."""

from __future__ import annotations

import pytest

from loanscope import registry
from loanscope.sources.derived import raw_tables


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return raw_tables(spark, sf_dir)


@pytest.mark.parametrize("name", registry.ON_RAW)
def test_no_cross_product_or_python(raw, name):
    text = plan(registry.ON_RAW[name](raw))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert operator not in text


@pytest.mark.parametrize("name", [n for n in registry.ON_RAW if n.startswith(("mart_", "agg_", "seg_"))])
def test_distinct_counts_do_not_copy_rows(raw, name):
    assert "Expand" not in plan(registry.ON_RAW[name](raw))


@pytest.mark.parametrize("name", ["win_latest_nps", "win_latest_snapshot", "mart_credit_vs_nps"])
def test_top_one_is_limited_before_the_shuffle(raw, name):
    assert "WindowGroupLimit" in plan(registry.ON_RAW[name](raw))


def test_scans_read_only_needed_columns(raw):
    text = plan(registry.ON_RAW["dq_unique"](raw))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text
