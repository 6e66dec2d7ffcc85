"""Marts built from loan-level weights against the same measures over joined rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loanscope.plans import enrich, marts, reports, segments, staging
from tests import samples

DATES = ("1/1/2025", "3/31/2025", "6/30/2025")
SALES = ("11/20/2024", "1/2/2025", "7/9/2023")

BIRTHS = (dt.date(1950, 1, 1), dt.date(1985, 6, 1), dt.date(2001, 12, 31), dt.date(2015, 1, 1))
STAMP = dt.datetime(2025, 5, 1, 12, 0, 0, 123456)


def loan_id(rng, loans):
    return rng.choice(["HOT", None, *(f"L{i}" for i in range(loans))])


@pytest.fixture(scope="module", params=[1, 2])
def raw(spark, request):
    """A hot loan with a third of every table, repeated snapshots, NULL ids and dates."""
    rng = random.Random(request.param)

    def rows(n, make, loans=9, ids="Loan Id"):
        chosen = ["HOT"] * (n // 3) + [loan_id(rng, loans) for _ in range(n - n // 3)]
        return [{ids: key, **make()} for key in chosen]

    def money():
        return rng.choice([None, float(rng.randrange(0, 5000))])

    return samples.raw_tables(
        spark,
        credit_data=rows(90, lambda: {
            "date": rng.choice([None, *DATES]), "sale_date": rng.choice([None, *SALES]),
            "balance": money(), "total_paid": money(), "arrears": money(),
            "days_past_due": rng.choice([None, 0, 12, 45, 75, 120]),
            "balance_due_status": rng.choice(["up to date", "Arrears", "Advance", "Paid Off", None]),
            "account_status_l2": rng.choice(["Active", "FPD", "Paid Off", "Inactive", "Default", None]),
        }, ids="loan_id"),
        customer_sales=rows(24, lambda: {
            "product_name": rng.choice(["Galaxy-S22", "Galaxy-A14", "Note 12", "iPhone 11", None]),
            "loan_term": rng.choice(["12M", "18M", "24M", "6M"]), "returned": rng.choice([0, 1, None]),
            "cash_price": money(), "loan_price": money(),
        }),
        customer_dob=rows(18, lambda: {"date_of_birth": rng.choice([None, *BIRTHS])}, ids="Loan Id "),
        customer_gender=rows(18, lambda: {"gender": rng.choice(["M", "f", "Other", None])}),
        customer_income=rows(18, lambda: {"duration": rng.choice([None, 0, 1, 4]), "received": money()}),
        nps_data=rows(30, lambda: {
            "Submission ID": rng.randrange(10**6), "nps_score": rng.choice([None, *range(11)]),
            "Submitted at": STAMP, "phone_locked_despite_payment": rng.choice(["Yes", "No", None]),
        }),
    )


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def assert_same(got, want):
    want = want.select(*got.columns)
    left, right = rows_of(got), rows_of(want)
    assert len(left) == len(right)
    for a, b in zip(left, right):
        for x, y in zip(a, b):
            assert x == y or x == pytest.approx(y, rel=1e-9), (a, b)


def distinct_if(condition, name):
    return F.countDistinct(F.when(F.expr(condition), F.col("loan_id"))).alias(name)


def test_portfolio(spark, raw):
    joined = enrich.credit_with_customer(raw)
    want = joined.groupBy("snapshot_date").agg(
        F.countDistinct("loan_id").alias("total_loans"),
        F.sum("balance").alias("total_balance"),
        F.sum("total_paid").alias("total_payments"),
        F.avg("days_past_due").alias("avg_days_past_due"),
        F.sum(F.expr("case when balance_due_status = 'Arrears' then arrears else 0 end")).alias("total_arrears_amount"),
        distinct_if("balance_due_status = 'Arrears'", "arrears_count"),
        distinct_if("days_past_due > 90", "dpd_90_plus"),
        distinct_if("product_name like '%Galaxy-S%'", "galaxy_s_loans"),
        distinct_if("loan_term = '12M'", "term_12m_loans"),
        distinct_if("returned > 0", "returned_devices"),
    )
    assert_same(marts.portfolio_performance(raw).select(*want.columns), want)


def test_cohorts(spark, raw):
    joined = marts.with_cohorts(enrich.credit_with_customer(raw)).where("cohort_quarter is not null")
    want = joined.groupBy("cohort_quarter", "cohort_age_quarters", "snapshot_date").agg(
        F.countDistinct("loan_id").alias("cohort_size"),
        F.avg("total_paid").alias("avg_total_paid"),
        (F.sum("total_paid") / F.expr("nullif(sum(total_paid + balance), 0)") * 100).alias("avg_repayment_rate_pct"),
        distinct_if("account_status_l2 = 'Paid Off'", "paid_off_count"),
        F.avg("days_past_due").alias("avg_dpd"),
    )
    assert_same(marts.cohort_analysis(raw).select(*want.columns), want)


@pytest.mark.parametrize(("report", "group", "known"), [
    (segments.by_age, "age_group", "age_group not in ('Unknown', 'None')"),
    (segments.by_income, "income_group", "income_group not in ('Unknown', 'None')"),
    (segments.by_gender, "gender", "gender is not null"),
])
def test_segments(spark, raw, report, group, known):
    joined = enrich.credit_with_customer(raw)
    latest = staging.at_latest_snapshot(joined).where(known)
    want = latest.groupBy(group).agg(
        F.countDistinct("loan_id").alias("total_loans"),
        F.round(F.avg("avg_monthly_income"), 0).alias("avg_income"),
        F.round(F.avg("days_past_due"), 1).alias("avg_dpd"),
        F.expr("round(count_if(balance_due_status = 'Arrears') * 100d / count(1), 1)").alias("arrears_rate_pct"),
    )
    assert_same(report(raw).select(*want.columns), want)


def test_age_distribution_and_coverage(spark, raw):
    latest = staging.at_latest_snapshot(enrich.credit_with_customer(raw))
    want = latest.groupBy("age_group").agg(F.countDistinct("loan_id").alias("loan_count"))
    assert_same(segments.age_distribution(raw).select("age_group", "loan_count"), want)
    total = latest.agg(
        F.countDistinct("loan_id").alias("total_loans"),
        distinct_if("age_group not in ('Unknown', 'None')", "with_age_group"),
        distinct_if("income_group not in ('Unknown', 'None')", "with_income_group"),
    )
    assert_same(segments.band_coverage(raw).select(*total.columns), total)


def test_joined_rows_equal_plain_joins(spark, raw):
    """Fan-out as in the literal form: customers × snapshots, then a join on both keys."""
    facts = staging.credit_snapshots(raw.credit_data).withColumnRenamed("return_date", "fact_return")
    people = staging.customers(raw.customer_sales).join(staging.demographics(raw), "loan_id", "left")
    dates = facts.select("snapshot_date").distinct()
    enriched = people.crossJoin(dates).drop("sale_date")
    want = facts.join(enriched, ["loan_id", "snapshot_date"], "left")
    columns = ["loan_id", "snapshot_date", "balance", "product_name", "date_of_birth", "gender", "avg_monthly_income"]
    assert rows_of(enrich.credit_with_customer(raw).select(*columns)) == rows_of(want.select(*columns))


def test_enriched_customers_cover_every_date(spark, raw):
    customers = enrich.customers_with_demographics(raw).count()
    dates = staging.credit_snapshots(raw.credit_data).select("snapshot_date").distinct().count()
    enriched = enrich.customer_enriched(raw)
    assert enriched.count() == customers * dates
    assert enriched.where("snapshot_date is null and age_group <> 'Unknown'").count() == 0


def test_equal_stamps_pick_the_last_submission(spark, raw):
    responses = staging.survey(raw.nps_data)
    want = {}
    for row in responses.select("loan_id", "submission_id", "nps_score").collect():
        if row.loan_id not in want or row.submission_id > want[row.loan_id][0]:
            want[row.loan_id] = (row.submission_id, row.nps_score)
    got = {r.loan_id: r.nps_score for r in enrich.latest_responses(responses).collect()}
    assert got == {key: score for key, (_, score) in want.items()}


def test_newest_response_without_score_drops_the_loan(spark):
    raw = samples.raw_tables(
        spark, credit_data=[{"loan_id": "A"}, {"loan_id": "B"}],
        nps_data=[
            {"Loan Id": "A", "Submission ID": 1, "Submitted at": STAMP, "nps_score": 9},
            {"Loan Id": "A", "Submission ID": 2, "Submitted at": STAMP + dt.timedelta(days=1)},
            {"Loan Id": "B", "Submission ID": 3, "Submitted at": STAMP, "nps_score": 3},
            {"Loan Id": "C", "Submission ID": 4, "Submitted at": STAMP, "nps_score": 3},
        ],
    )
    assert [r.loan_id for r in marts.credit_vs_nps(raw).collect()] == ["B"]


def test_schemas(spark, raw):
    portfolio = dict(marts.portfolio_performance(raw).dtypes)
    assert len(portfolio) == 34
    assert {portfolio[f"{n}_rate_pct"] for n in ("arrears", "fpd", "paid_off")} == {"float"}
    assert portfolio["payment_collection_pct"] == "double"
    cohort = dict(marts.cohort_analysis(raw).dtypes)
    assert len(cohort) == 15 and cohort["arrears_rate_pct"] == "float" and cohort["cohort_quarter"] == "date"
    assert len(marts.credit_vs_nps(raw).columns) == 20
    assert len(enrich.credit_with_customer(raw).columns) == 55
    assert len(enrich.credit_with_nps(raw).columns) == 64
    assert len(enrich.customer_enriched(raw).columns) == 26


def test_empty_tables(spark):
    raw = samples.raw_tables(spark)
    assert marts.portfolio_performance(raw).count() == 0
    assert marts.cohort_analysis(raw).count() == 0
    assert marts.credit_vs_nps(raw).count() == 0
    assert [r.Value for r in reports.summary_metrics(raw).collect()][:4] == ["0", "0", "0", "0"]
