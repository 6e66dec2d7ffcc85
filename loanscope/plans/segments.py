"""Reports by age, income and gender at the latest snapshot.

Rates count joined rows, so a loan with several customer or demographic records
weighs more; the weights come from the loan profile instead of the joined rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.functions import bands, calendar
from loanscope.operators import joins
from loanscope.operators.shares import arg_max, arg_min, percent_of_total, with_percentages
from loanscope.plans import loan_grain, staging
from loanscope.plans.staging import KEY
from loanscope.sources.derived import RawTables


def age_records(raw: RawTables) -> DataFrame:
    """(loan, age_group) of every birth record, aged at the latest snapshot."""
    latest = staging.latest_snapshot(staging.credit_snapshots(raw.credit_data))
    age = calendar.years_between(F.col("date_of_birth"), latest)
    return staging.births(raw.customer_dob).select(KEY, bands.age_group(age).alias("age_group"))


def income_records(raw: RawTables) -> DataFrame:
    income = F.col("avg_monthly_income")
    return staging.incomes(raw.customer_income).select(
        KEY, bands.income_group(income).alias("income_group"), "avg_monthly_income"
    )


def gender_records(raw: RawTables) -> DataFrame:
    return staging.genders(raw.customer_gender).select(KEY, "gender")


def _segments(records: DataFrame, group: str, side: str, raw: RawTables) -> DataFrame:
    """(loan, group) with the number of customer rows and the incomes on them."""
    per_group = records.groupBy(KEY, group)
    repeats = F.col("n_sale").cast("double")
    for other in ("dob", "gender"):
        if other != side:
            repeats = repeats * loan_grain.at_least_one(f"n_{other}")
    if side == "income":
        grouped = per_group.agg(
            F.count(F.lit(1)).alias("records"),
            F.sum("avg_monthly_income").alias("group_sum"),
            F.count("avg_monthly_income").alias("group_count"),
        )
        rows = repeats * F.col("records")
        incomes = ("group_sum", "group_count")
    else:
        grouped = per_group.agg(F.count(F.lit(1)).alias("records"))
        repeats = repeats * F.col("records")
        rows = repeats * loan_grain.at_least_one("n_income")
        incomes = ("income_sum", "income_count")
    return grouped.join(loan_grain.customer_profile(raw), KEY).select(
        KEY, group, rows.alias("customer_rows"),
        *((F.col(name) * repeats).alias(total) for name, total in zip(incomes, ("income_sum", "income_count"))),
    )


def _rows_with(flag: str) -> Column:
    return F.count_if(F.expr(loan_grain.FACT_FLAGS.conditions[flag]))


def _latest_loans(raw: RawTables) -> DataFrame:
    facts = staging.at_latest_snapshot(staging.credit_snapshots(raw.credit_data))
    return facts.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("facts"),
        F.sum("days_past_due").alias("dpd"),
        F.count("days_past_due").alias("n_dpd"),
        _rows_with("arrears_count").alias("n_arrears"),
        _rows_with("fpd_loans").alias("n_fpd"),
        _rows_with("paid_off_loans").alias("n_paid_off"),
    )


def _report(raw: RawTables, records: DataFrame, group: str, side: str, last: tuple[str, str]) -> DataFrame:
    rows = F.col("customer_rows")
    whole = F.sum(F.col("facts") * rows)

    def row_rate(part: str) -> Column:
        return F.round(F.sum(F.col(part) * rows) * F.lit(100.0) / whole, 1)

    def mean(total: Column, number: Column, digits: int) -> Column:
        return F.round(F.sum(total) / F.nullif(F.sum(number), F.lit(0.0)), digits)

    facts, (status_rows, status_rate) = F.col("facts"), last
    grouped = _latest_loans(raw).join(_segments(records, group, side, raw), KEY).groupBy(group).agg(
        F.count(F.lit(1)).alias("total_loans"),
        mean(F.col("income_sum") * facts, F.col("income_count") * facts, 0).alias("avg_income"),
        mean(F.col("dpd") * rows, F.col("n_dpd") * rows, 1).alias("avg_dpd"),
        row_rate("n_arrears").alias("arrears_rate_pct"),
        row_rate(status_rows).alias(status_rate),
    )
    return grouped.select(
        group, "total_loans", percent_of_total(F.col("total_loans")).alias("pct_of_portfolio"),
        "avg_income", "avg_dpd", "arrears_rate_pct", status_rate,
    )


def by_age(raw: RawTables) -> DataFrame:
    records = age_records(raw).where(bands.is_banded(F.col("age_group")))
    return _report(raw, records, "age_group", "dob", ("n_fpd", "fpd_rate_pct")).orderBy("age_group")


def by_income(raw: RawTables) -> DataFrame:
    records = income_records(raw).where(bands.is_banded(F.col("income_group")))
    report = _report(raw, records, "income_group", "income", ("n_paid_off", "paid_off_rate_pct"))
    return report.orderBy(bands.income_rank(F.col("income_group")))


def by_gender(raw: RawTables) -> DataFrame:
    records = gender_records(raw).where(F.col("gender").isNotNull())
    report = _report(raw, records, "gender", "gender", ("n_paid_off", "paid_off_rate_pct"))
    return report.orderBy(F.desc("total_loans"), "gender")


def extremes(raw: RawTables) -> DataFrame:
    """Largest segment and highest/lowest arrears rate, for age and income."""

    def of(report: DataFrame, segment: str, group: str, position: Column) -> DataFrame:
        label, share, rate = F.col(group), F.col("pct_of_portfolio"), F.col("arrears_rate_pct")
        picks = {
            "largest_segment": (arg_max(label, share, position), F.max(share)),
            "lowest_arrears_rate": (arg_min(label, rate, position), F.min(rate)),
            "highest_arrears_rate": (arg_max(label, rate, position), F.max(rate)),
            "first_arrears_rate": (F.min_by(label, position), F.min_by(rate, position)),
            "last_arrears_rate": (F.max_by(label, position), F.max_by(rate, position)),
        }
        rows = [
            F.struct(F.lit(segment).alias("segment"), F.lit(name).alias("measure"),
                     pick.alias("label"), value.alias("value"))
            for name, (pick, value) in picks.items()
        ]
        return report.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))

    income_position = bands.income_rank(F.col("income_group"))
    return of(by_age(raw), "age_group", "age_group", F.col("age_group")).unionAll(
        of(by_income(raw), "income_group", "income_group", income_position)
    )


def gender_split(raw: RawTables) -> DataFrame:
    """Male and female counts, their share of the two, arrears rates, and the top group."""
    report = by_gender(raw)

    def pick(gender: str, column: str) -> Column:
        return F.max(F.when(F.col("gender") == gender, F.col(column)))

    male, female = pick("Male", "total_loans"), pick("Female", "total_loans")
    both = F.nullif(male + female, F.lit(0).cast("bigint"))
    first = F.struct(-F.col("total_loans"), F.col("gender"))
    return report.agg(
        male.alias("male_loans"),
        F.round(male / both * 100, 1).alias("male_share_pct"),
        female.alias("female_loans"),
        F.round(female / both * 100, 1).alias("female_share_pct"),
        pick("Male", "arrears_rate_pct").alias("male_arrears_rate_pct"),
        pick("Female", "arrears_rate_pct").alias("female_arrears_rate_pct"),
        F.min_by("gender", first).alias("top_gender"),
        F.min_by("pct_of_portfolio", first).alias("top_gender_pct"),
    )


def age_distribution(raw: RawTables) -> DataFrame:
    """Loans per age group, with 'Unknown', and NULL for loans without a customer."""
    profile = loan_grain.customer_profile(raw).select(KEY, "n_dob")
    aged = age_records(raw).distinct().join(profile.select(KEY), KEY)
    unaged = profile.where(F.col("n_dob").isNull()).select(KEY, F.lit(bands.UNKNOWN).alias("age_group"))
    facts = staging.at_latest_snapshot(staging.credit_snapshots(raw.credit_data))
    loans = facts.groupBy(KEY).agg(F.max(F.col(KEY).isNotNull().cast("bigint")).alias("is_loan"))
    counted = loans.join(aged.unionByName(unaged), KEY, "left").groupBy("age_group").agg(
        F.sum("is_loan").alias("loan_count")
    )
    return counted.select(
        "age_group", "loan_count", percent_of_total(F.col("loan_count")).alias("pct")
    ).orderBy(F.asc_nulls_last("age_group"))


def band_coverage(raw: RawTables) -> DataFrame:
    """Loans of the latest snapshot with a known age group and income group."""
    facts = staging.at_latest_snapshot(staging.credit_snapshots(raw.credit_data))
    presence = joins.key_presence({
        "fact": facts,
        "sale": staging.customers(raw.customer_sales),
        "age": age_records(raw).where(bands.is_banded(F.col("age_group"))),
        "income": income_records(raw).where(bands.is_banded(F.col("income_group"))),
    }, KEY).where("has_fact")
    total = F.count(F.lit(1))
    counts = presence.agg(
        total.alias("total_loans"),
        F.count_if(F.col("has_sale") & F.col("has_age")).alias("with_age_group"),
        F.count_if(F.col("has_sale") & F.col("has_income")).alias("with_income_group"),
    )
    return with_percentages(counts, "total_loans", {
        "with_age_group": "age_group_pct", "with_income_group": "income_group_pct",
    })
