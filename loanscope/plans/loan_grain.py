"""Pre-aggregated inputs of the marts: one row per loan instead of joined rows.

The marts are defined over facts joined with every matching customer row, where
repeated customers and demographic records multiply the rows. None of them needs
those rows themselves. A loan's joined rows number

    facts × sales × max(births, 1) × max(genders, 1) × max(incomes, 1)

so sums and counts over the join are per-loan sums times that weight, and
distinct counts are per-loan flags. Each input is reduced to its loans first
(map-side), which also takes hot loans out of every shuffle that follows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.operators.flags import FlagSet
from loanscope.plans import staging
from loanscope.plans.staging import KEY
from loanscope.sources.derived import RawTables

SALE_FLAGS = FlagSet(
    {
        "galaxy_s_loans": "product_name like '%Galaxy-S%'",
        "galaxy_a_loans": "product_name like '%Galaxy-A%'",
        "note_loans": "product_name like '%Note%'",
        "iphone_loans": "product_name like '%iPhone%'",
        "term_12m_loans": "loan_term = '12M'",
        "term_18m_loans": "loan_term = '18M'",
        "term_24m_loans": "loan_term = '24M'",
        "returned_devices": "returned > 0",
    },
    "sale_mask",
)
FACT_FLAGS = FlagSet(
    {
        "active_loans": "account_status_l2 = 'Active'",
        "fpd_loans": "account_status_l2 = 'FPD'",
        "paid_off_loans": "account_status_l2 = 'Paid Off'",
        "inactive_loans": "account_status_l2 = 'Inactive'",
        "up_to_date_count": "balance_due_status = 'up to date'",
        "arrears_count": "balance_due_status = 'Arrears'",
        "advance_count": "balance_due_status = 'Advance'",
        "dpd_0": "days_past_due = 0",
        "dpd_1_30": "days_past_due between 1 and 30",
        "dpd_31_60": "days_past_due between 31 and 60",
        "dpd_61_90": "days_past_due between 61 and 90",
        "dpd_90_plus": "days_past_due > 90",
    },
    "fact_mask",
)


def at_least_one(count: str) -> Column:
    return F.greatest(F.coalesce(count, F.lit(0)), F.lit(1)).cast("double")


def customer_profile(raw: RawTables) -> DataFrame:
    """One row per loan with a sale: record counts, sale flags and the join weight.

    All four inputs go through one union and one aggregate, hence one shuffle.
    """
    sales = staging.customers(raw.customer_sales).select(KEY, SALE_FLAGS.pack())
    incomes = staging.incomes(raw.customer_income).select(KEY, "avg_monthly_income")
    sides = {
        "sale": sales,
        "dob": staging.births(raw.customer_dob).select(KEY),
        "gender": staging.genders(raw.customer_gender).select(KEY),
        "income": incomes,
    }
    tagged = [df.withColumn(f"n_{name}", F.lit(1).cast("bigint")) for name, df in sides.items()]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    counted = union.groupBy(KEY).agg(
        *(F.sum(f"n_{name}").alias(f"n_{name}") for name in sides),
        SALE_FLAGS.merge(),
        F.sum("avg_monthly_income").alias("income_sum"),
        F.count("avg_monthly_income").alias("income_count"),
    )
    # In doubles: whole numbers up to 2^53, and no overflow for a loan repeated in every input.
    weight = F.col("n_sale") * at_least_one("n_dob") * at_least_one("n_gender") * at_least_one("n_income")
    return counted.where(F.col("n_sale") > 0).withColumn("weight", weight)


def fact_loans(facts: DataFrame, *keys: str, measures: list[Column]) -> DataFrame:
    """Facts reduced to (keys, loan). ``is_loan`` is 0 for rows without a loan id."""
    grain = facts.groupBy(*keys, KEY).agg(*measures)
    return grain.withColumn("is_loan", F.col(KEY).isNotNull().cast("bigint"))


def weigh(loans: DataFrame, profile: DataFrame) -> DataFrame:
    """Attach the join weight (1 where no customer row matches) and the sale flags.

    Facts without a snapshot date match no customer.
    """
    columns = profile.select(F.col(KEY).alias("_loan"), "weight", SALE_FLAGS.column)
    match = (F.col(KEY) == F.col("_loan")) & F.col("snapshot_date").isNotNull()
    joined = loans.join(columns, match, "left").drop("_loan")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(1.0)))


def loan_flags(mask: str) -> Column:
    """Flags of rows without a loan id count for nothing."""
    return F.when(F.col("is_loan") == 1, F.col(mask)).otherwise(F.lit(0).cast("bigint")).alias(mask)
