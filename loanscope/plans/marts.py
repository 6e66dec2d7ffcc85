"""Portfolio, cohort and credit-versus-satisfaction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.functions import bands, calendar, money
from loanscope.operators.latest import latest_per_key
from loanscope.plans import enrich, loan_grain, staging
from loanscope.plans.loan_grain import FACT_FLAGS, SALE_FLAGS
from loanscope.plans.staging import KEY
from loanscope.sources.derived import RawTables

FACT_FLAG_NAMES = tuple(FACT_FLAGS.conditions)


def _sum_of(flag: str, value: str) -> Column:
    met = F.expr(FACT_FLAGS.conditions[flag])
    return F.sum(F.when(met, F.col(value)).otherwise(F.lit(0.0)))


def _weighted(name: str) -> Column:
    return F.sum(F.col(name) * F.col("weight"))


def _mean(total: str, count: str) -> Column:
    return _weighted(total) / F.nullif(_weighted(count), F.lit(0.0))


def _portfolio_measures() -> dict[str, Column]:
    return {
        "balance": F.sum("balance"),
        "paid": F.sum("total_paid"),
        "arrears": F.sum("arrears"),
        "dpd": F.sum("days_past_due"),
        "n_dpd": F.count("days_past_due"),
        "current_balance": _sum_of("up_to_date_count", "balance"),
        "late_balance": _sum_of("arrears_count", "balance"),
        "late_arrears": _sum_of("arrears_count", "arrears"),
        FACT_FLAGS.column: F.bit_or(FACT_FLAGS.pack()),
    }


def _cohort_measures() -> dict[str, Column]:
    return {
        "paid": F.sum("total_paid"),
        "n_paid": F.count("total_paid"),
        "balance": F.sum("balance"),
        "n_balance": F.count("balance"),
        "owed": F.sum(F.col("total_paid") + F.col("balance")),
        "dpd": F.sum("days_past_due"),
        "n_dpd": F.count("days_past_due"),
        FACT_FLAGS.column: F.bit_or(FACT_FLAGS.pack()),
    }


def _named(measures: dict[str, Column]) -> list[Column]:
    return [measure.alias(name) for name, measure in measures.items()]


def portfolio_states(facts: DataFrame, *extra: str) -> DataFrame:
    """(snapshot, loan) rows with fact sums and flags."""
    return loan_grain.fact_loans(facts, "snapshot_date", *extra, measures=_named(_portfolio_measures()))


def portfolio_loans(facts: DataFrame, raw: RawTables) -> DataFrame:
    """(snapshot, loan) rows with fact sums, flags and join weight."""
    return loan_grain.weigh(portfolio_states(facts), loan_grain.customer_profile(raw))


def portfolio_performance(raw: RawTables, latest_only: bool = False) -> DataFrame:
    """One row per snapshot: size, balances, status, days past due, products, rates."""
    facts = staging.credit_snapshots(raw.credit_data)
    if latest_only:
        facts = staging.at_latest_snapshot(facts)
    return portfolio_of(portfolio_states(facts), raw)


def portfolio_of(states: DataFrame, raw: RawTables) -> DataFrame:
    """The portfolio table from one state per (snapshot, loan)."""
    weighed = loan_grain.weigh(states, loan_grain.customer_profile(raw))
    loans = weighed.withColumns({
        mask: loan_grain.loan_flags(mask) for mask in (FACT_FLAGS.column, SALE_FLAGS.column)
    })
    levels, dues, buckets = FACT_FLAG_NAMES[:4], FACT_FLAG_NAMES[4:7], FACT_FLAG_NAMES[7:]
    metrics = loans.groupBy("snapshot_date").agg(
        F.sum("is_loan").alias("total_loans"),
        _weighted("balance").alias("total_balance"),
        _weighted("paid").alias("total_payments"),
        _weighted("arrears").alias("total_arrears"),
        _mean("dpd", "n_dpd").alias("avg_days_past_due"),
        *FACT_FLAGS.counts(*levels, *dues),
        _weighted("current_balance").alias("up_to_date_balance"),
        _weighted("late_balance").alias("arrears_balance"),
        _weighted("late_arrears").alias("total_arrears_amount"),
        *FACT_FLAGS.counts(*buckets),
        *SALE_FLAGS.counts(),
    )
    loans_total, balance = F.col("total_loans"), F.col("total_balance")
    return metrics.select(
        "*",
        money.rate32(F.col("arrears_count"), loans_total).alias("arrears_rate_pct"),
        money.rate32(F.col("fpd_loans"), loans_total).alias("fpd_rate_pct"),
        money.rate32(F.col("paid_off_loans"), loans_total).alias("paid_off_rate_pct"),
        money.rate(F.col("total_arrears_amount"), balance).alias("arrears_balance_pct"),
        money.rate(F.col("total_payments"), balance).alias("payment_collection_pct"),
    ).orderBy(F.asc_nulls_last("snapshot_date"))


def with_cohorts(facts: DataFrame) -> DataFrame:
    start = calendar.quarter_start(F.col("sale_date"))
    age = calendar.quarters_between(F.col("sale_date"), F.col("snapshot_date"))
    return facts.withColumns({"cohort_quarter": start, "cohort_age_quarters": age})


COHORT_KEYS = ("cohort_quarter", "cohort_age_quarters", "snapshot_date")


def cohort_states(facts: DataFrame, *extra: str) -> DataFrame:
    """(cohort, loan) rows with fact sums and flags."""
    dated = with_cohorts(facts).where(F.col("cohort_quarter").isNotNull())
    return loan_grain.fact_loans(dated, *COHORT_KEYS, *extra, measures=_named(_cohort_measures()))


def loan_states(facts: DataFrame, *extra: str) -> DataFrame:
    """(cohort, loan) rows with the fact sums and flags of both tables; facts without a cohort are in it."""
    measures = _named({**_portfolio_measures(), **_cohort_measures()})
    return loan_grain.fact_loans(with_cohorts(facts), *COHORT_KEYS, *extra, measures=measures)


def cohort_analysis(raw: RawTables) -> DataFrame:
    """One row per sale quarter, cohort age and snapshot."""
    return cohort_of(cohort_states(staging.credit_snapshots(raw.credit_data)), raw)


def cohort_of(states: DataFrame, raw: RawTables) -> DataFrame:
    """The cohort table from one state per (cohort, loan)."""
    keys = COHORT_KEYS
    weighed = loan_grain.weigh(states, loan_grain.customer_profile(raw))
    weighed = weighed.withColumn(FACT_FLAGS.column, loan_grain.loan_flags(FACT_FLAGS.column))
    metrics = weighed.groupBy(*keys).agg(
        F.sum("is_loan").alias("cohort_size"),
        _mean("paid", "n_paid").alias("avg_total_paid"),
        _mean("balance", "n_balance").alias("avg_balance"),
        (_weighted("paid") / F.nullif(_weighted("owed"), F.lit(0.0)) * 100).alias("avg_repayment_rate_pct"),
        FACT_FLAGS.count("arrears_count", "arrears_count"),
        _mean("dpd", "n_dpd").alias("avg_dpd"),
        FACT_FLAGS.count("active_loans", "active_count"),
        FACT_FLAGS.count("fpd_loans", "fpd_count"),
        FACT_FLAGS.count("paid_off_loans", "paid_off_count"),
        FACT_FLAGS.count("inactive_loans", "inactive_count"),
    )
    size = F.nullif(F.col("cohort_size"), F.lit(0).cast("bigint"))
    return metrics.select(
        *keys, "cohort_size", "avg_total_paid", "avg_balance", "avg_repayment_rate_pct", "arrears_count",
        money.share32(F.col("arrears_count"), size).alias("arrears_rate_pct"),
        "avg_dpd", "active_count", "fpd_count", "paid_off_count", "inactive_count",
        money.share32(F.col("paid_off_count"), size).alias("paid_off_rate_pct"),
    ).orderBy(*map(F.asc_nulls_last, keys))


FACT_COLUMNS = (
    "snapshot_date", "balance", "total_paid", "arrears", "days_past_due", "balance_due_status",
    "account_status_l2",
)


def fact_order() -> list[Column]:
    """Newest snapshot row first; equal dates are told apart by the other columns."""
    return [F.desc_nulls_last("snapshot_date"), *map(F.asc_nulls_last, FACT_COLUMNS[1:])]


def latest_facts(facts: DataFrame) -> DataFrame:
    """Newest snapshot row of each loan."""
    return latest_per_key(facts.select(KEY, *FACT_COLUMNS), KEY, *fact_order())


def scored_loans(raw: RawTables, newest: DataFrame | None = None) -> DataFrame:
    """Newest fact of every loan whose newest response has a score, with bands.

    A loan whose newest response lacks a score drops out even if an older one has it. ``newest`` are
    the newest facts if they are stored already; the facts of ``raw`` are not read then.
    """
    if newest is None:
        newest = latest_facts(staging.credit_snapshots(raw.credit_data).where(F.col(KEY).isNotNull()))
    facts = newest.where(F.col(KEY).isNotNull())
    scored = enrich.latest_responses(staging.survey(raw.nps_data)).where(F.col("nps_score").isNotNull())
    arrears, dpd = F.col("arrears"), F.col("days_past_due")
    return facts.join(scored.drop("submitted_at"), KEY).withColumns({
        "dpd_bucket": bands.dpd_bucket(dpd),
        "payment_performance": bands.payment_performance(F.col("balance_due_status"), arrears, dpd),
    })


def credit_vs_nps(raw: RawTables, newest: DataFrame | None = None) -> DataFrame:
    """One row per loan with a score: newest snapshot (``newest``, if stored), response, product, bands."""
    product = ("product_name", "loan_term")
    sale = latest_per_key(
        staging.customers(raw.customer_sales).select(KEY, *product), KEY, *map(F.asc_nulls_last, product)
    ).select(F.col(KEY).alias("_loan"), *product)
    match = (F.col(KEY) == F.col("_loan")) & F.col("snapshot_date").isNotNull()
    return scored_loans(raw, newest).join(sale, match, "left").select(
        KEY, "snapshot_date", "nps_score", "nps_category", *FACT_COLUMNS[1:],
        *enrich.RESPONSE_COLUMNS[3:], *product, "dpd_bucket", "payment_performance",
    )


def _rows(condition: Column) -> Column:
    return F.count_if(condition)


def nps_summary_by_category(raw: RawTables) -> DataFrame:
    arrears = _rows(F.col("balance_due_status") == "Arrears")
    return scored_loans(raw).groupBy("nps_category").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.avg("nps_score").alias("avg_nps_score"),
        F.avg("days_past_due").alias("avg_dpd"),
        arrears.alias("arrears_count"),
        money.share32(arrears, F.count(F.lit(1))).alias("arrears_rate_pct"),
        F.avg("balance").alias("avg_balance"),
        F.avg("total_paid").alias("avg_total_paid"),
        _rows(F.col("phone_locked_despite_payment") == "Yes").alias("phone_locked_count"),
        _rows(F.col("experienced_payment_delay") == "Yes").alias("payment_delay_count"),
        _rows(F.col("difficulty_getting_support") == "Yes").alias("support_issues_count"),
    )


def nps_summary_by_payment(raw: RawTables) -> DataFrame:
    category = F.col("nps_category")
    counts = scored_loans(raw).groupBy("payment_performance").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.avg("nps_score").alias("avg_nps_score"),
        _rows(category == "Promoter").alias("promoters"),
        _rows(category == "Passive").alias("passives"),
        _rows(category == "Detractor").alias("detractors"),
    )
    # 32-bit throughout, as each count is narrowed before subtracting.
    net = (F.col("promoters").cast("float") - F.col("detractors").cast("float")).cast("float")
    return counts.withColumn("nps_score_calculated", money.share32(net, F.col("loan_count")))
