"""Marts from stored states, and tables replaced as one act."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loanscope.plans import marts, states
from loanscope.sinks import tables
from loanscope.sources import files, sample_files
from loanscope.sources.derived import RawTables, raw_tables
from loanscope.sources.scratch import scratch_dir
from loanscope.streaming import ingest
from tests import samples


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_only_new_batches_are_read(spark, sf_dir):
    raw, folder, target = raw_tables(spark, sf_dir), scratch_dir(spark), scratch_dir(spark)
    snapshots = list(sample_files.snapshot_rows(raw).items())
    early = F.crc32("loan_id") % 2 == 0
    assert states.update(spark, target) == []
    assert all(states.mart(spark, target, name, raw).count() == 0 for name in states.KINDS)
    seen = []
    for n, part in enumerate((early, ~early)):  # the second time late part files of a known snapshot
        for table, df in snapshots[: n + 1]:
            sample_files.write_snapshot(df.where(part), folder, table, mode="append")
        ingest.ingest(spark, folder, target)
        new = states.update(spark, target)
        seen += new
        plan = ingest.batch_facts(spark, target, new)._jdf.queryExecution().executedPlan().toString()
        assert new and "PartitionFilters: [" in plan and ingest.BATCH in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert states.update(spark, target) == []
    assert len(seen) == len(set(seen))
    facts = ingest.facts(spark, target)
    names = [name for name in ("customer_sales", "customer_dob", "customer_gender", "customer_income", "nps_data")]
    ingested = RawTables(credit_data=lambda: facts, **{name: (lambda name=name: getattr(raw, name)) for name in names})
    assert rows(states.mart(spark, target, "mart_portfolio_performance", raw)) == rows(marts.portfolio_performance(ingested))
    assert rows(states.mart(spark, target, "mart_cohort_analysis", raw)) == rows(marts.cohort_analysis(ingested))


def test_states_of_both_marts_are_stored_and_dealt_once(spark, tmp_path):
    raw = samples.raw_tables(
        spark, customer_sales=[{"Loan Id": "A", "sale_id": 1, "product_name": "iPhone 11"}] * 2,
        credit_data=[
            {"loan_id": "A", "balance": 2.0, "total_paid": 1.0, "days_past_due": 40},
            {"loan_id": "A", "balance": 3.0, "total_paid": None, "days_past_due": None, "sale_date": "1/2/2024"},
            {"loan_id": "A", "balance": None, "total_paid": 4.0, "sale_date": None, "account_status_l2": "FPD"},
            {"loan_id": None, "balance": 5.0, "total_paid": 6.0}, {"loan_id": "B", "date": "3/31/2025", "balance": 7.0},
        ],
    )
    folder, target = str(tmp_path / "raw"), str(tmp_path / "target")
    raw.credit_data.write.options(**files.CSV_OPTIONS).csv(f"{folder}/Credit Data - 01-01-2025.csv")
    ingest.ingest(spark, folder, target)
    states.update(spark, target)
    stored = spark.read.parquet(f"{target}/{states.STATES}")
    assert stored.count() == 5
    for name, want in (("mart_portfolio_performance", marts.portfolio_performance), ("mart_cohort_analysis", marts.cohort_analysis)):
        found = states.mart(spark, target, name, raw)
        dealt = re.findall(r"hashpartitioning\(([^)]*)\)", found._jdf.queryExecution().executedPlan().toString())
        assert not any("loan_id" in keys and "snapshot_date" in keys for keys in dealt)
        assert sum(keys.startswith("loan_id") for keys in dealt) == 2  # states and customers, each once
        assert rows(found) == rows(want(raw))


def test_newest_facts_follow_batches(spark, sf_dir):
    raw, folder, target = raw_tables(spark, sf_dir), scratch_dir(spark), scratch_dir(spark)
    assert states.update_newest(spark, target) == [] and states.newest_facts(spark, target).count() == 0
    snapshots = list(sample_files.snapshot_rows(raw).items())
    early = F.crc32("loan_id") % 2 == 0
    for part, some in ((early, snapshots[1:3]), (~early, snapshots[1:3]), (early, snapshots[:1])):  # the oldest comes last
        for table, df in some:
            sample_files.write_snapshot(df.where(part), folder, table, mode="append")
        ingest.ingest(spark, folder, target)
        assert states.update_newest(spark, target) and states.update_newest(spark, target) == []
        ranked = marts.latest_facts(ingest.facts(spark, target))
        assert sorted(map(str, rows(states.newest_facts(spark, target)))) == sorted(map(str, rows(ranked)))


def test_merging_is_right_with_ties_and_twice(spark, tmp_path):
    order = lambda: [F.desc_nulls_last("t"), F.asc_nulls_last("v")]
    batches = [[("a", 1, 5), ("a", 3, 9), ("b", None, 1), (None, 2, 2)], [("a", 3, 7), ("b", 0, 4), ("c", 1, 1)], [("a", 2, 0), ("c", 1, None), (None, 2, 1)]]
    path, schema = str(tmp_path / "t"), "k string, t int, v int"
    for n in (0, 1, 0, 2):
        states.merge_newest(spark.createDataFrame(batches[n], schema), path, "k", order())
    found = {tuple(r) for r in tables.current_table(spark, path).collect()}
    assert found == {("a", 3, 7), ("b", 0, 4), ("c", 1, 1), (None, 2, 1)}


def test_replacement_is_one_act(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        tables.current_table(spark, path)
    bad = F.when(F.col("id") == 9, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id"))
    with pytest.raises(Exception):
        tables.replace_table(spark.range(10).select(bad.alias("id")), path)
    assert tables.current_version(spark, path) is None
    tables.replace_table(spark.range(3), path)
    reader = tables.current_table(spark, path)
    with pytest.raises(Exception):
        tables.replace_table(spark.range(10).select(bad.alias("id")), path)
    assert sorted(rows(tables.current_table(spark, path))) == [(0,), (1,), (2,)]
    tables.replace_table(reader.select((F.col("id") + 10).alias("id")), path)
    assert sorted(rows(tables.current_table(spark, path))) == [(10,), (11,), (12,)]
    assert sorted(rows(reader)) == [(0,), (1,), (2,)]


def test_names_follow_the_version(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql(f"create database named_versions location '{tmp_path}/db'")
    for n in (2, 5):
        tables.replace_table(spark.range(n), path)
        assert tables.name_table(spark, "named_versions.t", tables.version_path(spark, path)).count() == n
