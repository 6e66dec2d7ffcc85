"""Trend, KPI, response and summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.functions import bands, money
from loanscope.operators.reshape import columns_to_rows, expressions_to_rows
from loanscope.plans import marts, staging
from loanscope.plans.staging import KEY
from loanscope.sources.derived import RawTables

# Bucket labels in column order.
DPD_LABELS = {
    "dpd_0": "Current", "dpd_1_30": "1-30 DPD", "dpd_31_60": "31-60 DPD",
    "dpd_61_90": "61-90 DPD", "dpd_90_plus": "90+ DPD",
}


def portfolio_trend(raw: RawTables) -> DataFrame:
    return marts.portfolio_performance(raw).select(
        "snapshot_date", "total_loans", "total_balance", "arrears_rate_pct", "fpd_rate_pct",
        "paid_off_rate_pct", (F.col("total_balance") / 1e6).alias("balance_millions"),
    )


def dpd_distribution(raw: RawTables) -> DataFrame:
    portfolio = marts.portfolio_performance(raw)
    return columns_to_rows(portfolio, ["snapshot_date"], DPD_LABELS, "dpd_bucket", "loans")


def growth(raw: RawTables) -> DataFrame:
    """Loans at the first and last snapshot and the growth between them."""
    facts = staging.credit_snapshots(raw.credit_data)
    sizes = facts.groupBy("snapshot_date").agg(F.countDistinct(KEY).alias("loans"))
    date = F.col("snapshot_date")
    ends = sizes.agg(
        F.min_by("loans", date).alias("first_loans"), F.max_by("loans", date).alias("last_loans")
    )
    first = F.nullif(F.col("first_loans"), F.lit(0).cast("bigint"))
    return ends.withColumn("growth_pct", (F.col("last_loans") / first - 1) * 100)


def latest_kpis(raw: RawTables) -> DataFrame:
    """Six KPI rows of the latest snapshot, formatted, with the note that goes with each."""
    portfolio = marts.portfolio_performance(raw, latest_only=True)

    def percent(name: str):
        return F.concat(money.fixed(F.col(name), 2), F.lit("%"))

    # Metric names and notes.
    return expressions_to_rows(portfolio, ["metric", "value", "note"], [
        ("1. Arrears Rate", percent("arrears_rate_pct"), "Critical if >10%"),
        ("2. FPD Rate", percent("fpd_rate_pct"), "Early warning indicator"),
        ("3. Avg Days Past Due", F.concat(money.fixed(F.col("avg_days_past_due"), 1), F.lit(" days")),
         "Portfolio aging trend"),
        ("4. 90+ DPD Count", F.concat(money.thousands(F.col("dpd_90_plus")), F.lit(" loans")),
         "Likely write-offs"),
        ("5. Paid Off Rate", percent("paid_off_rate_pct"), "Success rate"),
        ("6. Collection Rate", percent("payment_collection_pct"), "Payment efficiency"),
    ])


def write_off_rate(raw: RawTables) -> DataFrame:
    """Loans more than 90 days past due at the latest snapshot, in percent."""
    portfolio = marts.portfolio_performance(raw, latest_only=True)
    rate = F.col("dpd_90_plus") / F.nullif(F.col("total_loans"), F.lit(0).cast("bigint")) * 100
    return portfolio.select("snapshot_date", "dpd_90_plus", "total_loans", rate.alias("dpd_90_plus_pct"))


def response_rate(raw: RawTables) -> DataFrame:
    """Scored loans against all loans of the latest snapshot."""
    facts = staging.credit_snapshots(raw.credit_data)
    total = staging.at_latest_snapshot(facts).agg(F.countDistinct(KEY).alias("n"))
    counts = marts.scored_loans(raw).agg(F.count(F.lit(1)).alias("scored_loans")).select(
        "scored_loans", total.scalar().alias("total_loans")
    )
    whole = F.nullif(F.col("total_loans"), F.lit(0).cast("bigint"))
    return counts.withColumn("response_rate_pct", F.col("scored_loans") / whole * 100)


def _score_counts(raw: RawTables, key: str) -> DataFrame:
    """(key, score) with its number of loans: at most eleven rows per key."""
    scored = marts.scored_loans(raw).where(F.col(key).isNotNull())
    return scored.groupBy(key, "nps_score").agg(F.count(F.lit(1)).alias("n"))


def _mean_score() -> Column:
    return F.sum(F.col("nps_score") * F.col("n")) / F.sum("n")


def nps_by_payment_performance(raw: RawTables) -> DataFrame:
    median = F.percentile("nps_score", F.lit(0.5), F.col("n"))
    return _score_counts(raw, "payment_performance").groupBy("payment_performance").agg(
        F.sum("n").alias("count"),
        F.bround(_mean_score(), 2).alias("avg_nps"),
        F.bround(median, 2).alias("median_nps"),
    ).orderBy(F.desc("avg_nps"), "payment_performance")


def nps_by_category(raw: RawTables) -> DataFrame:
    return _score_counts(raw, "nps_category").groupBy("nps_category").agg(
        F.sum("n").alias("count"), F.bround(_mean_score(), 1).alias("avg_nps")
    ).orderBy("nps_category")


def nps_distribution(raw: RawTables) -> DataFrame:
    """Five-number summary of the scores per payment class, interpolated linearly."""
    names = {"min_score": 0.0, "q1_score": 0.25, "median_score": 0.5, "q3_score": 0.75, "max_score": 1.0}
    points = F.percentile("nps_score", F.array(*map(F.lit, names.values())), F.col("n")).alias("points")
    summary = _score_counts(raw, "payment_performance").groupBy("payment_performance").agg(points)
    position = F.array_position(F.array(*map(F.lit, bands.PAYMENT_ORDER)), F.col("payment_performance"))
    return summary.select(
        "payment_performance", *(F.col("points")[i].alias(name) for i, name in enumerate(names))
    ).orderBy(position)


def summary_metrics(raw: RawTables) -> DataFrame:
    """Five headline metrics as formatted text."""
    facts = staging.credit_snapshots(raw.credit_data)
    customers = staging.customers(raw.customer_sales)
    counts = response_rate(raw).select(
        "*",
        customers.agg(F.countDistinct(KEY).alias("n")).scalar().alias("customers"),
        facts.agg(F.count(F.lit(1)).alias("n")).scalar().alias("records"),
    )
    # Metric names.
    return expressions_to_rows(counts, ["Metric", "Value"], [
        ("Total Loans (Latest Snapshot)", money.thousands(F.col("total_loans"))),
        ("Total Unique Customers", money.thousands(F.col("customers"))),
        ("Total Credit Snapshot Records", money.thousands(F.col("records"))),
        ("NPS Survey Responses", money.thousands(F.col("scored_loans"))),
        ("NPS Response Rate (%)", F.concat(money.fixed(F.col("response_rate_pct"), 1), F.lit("%"))),
    ])
