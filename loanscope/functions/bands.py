"""Band and label rules. Within a rule the first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Closed intervals and their labels.
AGE_BANDS = ((18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"))
AGE_ABOVE = (55, "Above 55")
INCOME_BELOW = (5000, "Below 5,000")
INCOME_BANDS = (
    (5000, 9999, "5,000-9,999"),
    (10000, 19999, "10,000-19,999"),
    (20000, 29999, "20,000-29,999"),
    (30000, 49999, "30,000-49,999"),
    (50000, 99999, "50,000-99,999"),
    (100000, 149999, "100,000-149,999"),
)
INCOME_FROM = (150000, "150,000 and above")
DPD_BANDS = ((0, 0, "Current"), (1, 30, "1-30 DPD"), (31, 60, "31-60 DPD"), (61, 90, "61-90 DPD"))
DPD_REST = "90+ DPD"
UNKNOWN = "Unknown"
UNBANDED = (UNKNOWN, "None")

INCOME_ORDER = (INCOME_BELOW[1], *(label for _, _, label in INCOME_BANDS), INCOME_FROM[1])
PAYMENT_ORDER = ("Excellent", "Good", "Fair", "Poor", UNKNOWN)


def _intervals(value: Column, bands: Sequence[tuple[int, int, str]], chain: Column | None = None):
    for low, high, label in bands:
        chain = (F if chain is None else chain).when(value.between(low, high), F.lit(label))
    return chain


def age_group(age: Column) -> Column:
    limit, label = AGE_ABOVE
    return _intervals(age, AGE_BANDS).when(age > limit, F.lit(label)).otherwise(F.lit(UNKNOWN))


def income_group(monthly_income: Column) -> Column:
    """Whole-number band edges: an income between two bands (9,999.57) is 'Unknown'."""
    low, low_label = INCOME_BELOW
    high, high_label = INCOME_FROM
    chain = F.when(monthly_income < low, F.lit(low_label))
    chain = _intervals(monthly_income, INCOME_BANDS, chain)
    return chain.when(monthly_income >= high, F.lit(high_label)).otherwise(F.lit(UNKNOWN))


def income_rank(group: Column) -> Column:
    """1 for the lowest band up to 8; NULL for a label outside the list."""
    position = F.array_position(F.array(*map(F.lit, INCOME_ORDER)), group)
    return F.nullif(position, F.lit(0).cast("bigint"))


def dpd_bucket(days_past_due: Column) -> Column:
    """Loan-level bucket; NULL, negative and fractional days fall into the last one."""
    return _intervals(days_past_due, DPD_BANDS).otherwise(F.lit(DPD_REST))


def nps_category(score: Column) -> Column:
    """A NULL score counts as 'Detractor' here; marts drop such responses later."""
    return F.when(score >= 9, "Promoter").when(score >= 7, "Passive").otherwise("Detractor")


def payment_performance(status: Column, arrears: Column, days_past_due: Column) -> Column:
    overdue = arrears > 0
    return (
        F.when(status == "up to date", "Good")
        .when(status == "Advance", "Excellent")
        .when(overdue & (days_past_due <= 30), "Fair")
        .when(overdue & (days_past_due > 30), "Poor")
        .otherwise(UNKNOWN)
    )


def is_banded(group: Column) -> Column:
    """True for a known band, false for 'Unknown'/'None', NULL for NULL."""
    return ~group.isin(*UNBANDED)
