"""Row-level joins of facts, customers, demographics and survey responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loanscope.functions import bands, calendar, money
from loanscope.operators import joins
from loanscope.operators.latest import latest_per_key
from loanscope.plans import staging
from loanscope.plans.staging import KEY
from loanscope.sources.derived import RawTables

DEMOGRAPHIC_COLUMNS = (
    "date_of_birth", "citizenship", "gender", "duration", "avg_monthly_income", "total_income",
)
CUSTOMER_COLUMNS = (
    "product_name", "product_model", "loan_term", "business_model", "client_model", "seller",
    "seller_type", "cash_price", "loan_price", "returned",
)
RESPONSE_COLUMNS = (
    "nps_score", "nps_category", "submitted_at", "happy_with_device_quality", "happy_with_service",
    "experienced_payment_delay", "difficulty_getting_support", "battery_issues",
    "phone_locked_despite_payment",
)


def _customer_sides(raw: RawTables) -> dict[str, DataFrame]:
    return {"sale": staging.customers(raw.customer_sales), **staging.demographic_sides(raw)}


def _people_rows() -> Column:
    """Rows per loan of the sales with their demographic records."""
    return joins.rows_of("sale", "dob", "gender", "income")


def customers_with_demographics(raw: RawTables, sizes: DataFrame | None = None) -> DataFrame:
    """Every sale with every combination of its birth, gender and income records."""
    sides = _customer_sides(raw)
    sizes = joins.stored_sizes(sides, KEY) if sizes is None else sizes
    some_record = F.col("has_dob") | F.col("has_gender")
    total_without_income = F.when(some_record, F.lit(0.0))
    padding = {"income": {"total_income": total_without_income}}
    result, done = sides.pop("sale"), ["sale"]
    for name, side in sides.items():
        needed = F.col("has_sale") & ~F.col(f"has_{name}")
        kept = side.select(KEY, *(c for c in side.columns if c in DEMOGRAPHIC_COLUMNS))
        padded = joins.pad(kept, sizes, needed, KEY, **padding.get(name, {}))
        result = joins.split_join(result, padded, KEY, sizes, joins.rows_of(*done), joins.rows_of(name))
        done.append(name)
    return result


def _age(snapshot_date: Column) -> Column:
    return calendar.years_between(F.col("date_of_birth"), snapshot_date)


def snapshot_dates(facts: DataFrame) -> DataFrame:
    return facts.select("snapshot_date").distinct()


def customer_enriched(raw: RawTables) -> DataFrame:
    """Every customer row at every snapshot date, with age and bands at that date.

    The dates (at most one per calendar day) come as one array from a scalar
    subquery and are unrolled per row, so customers are neither shuffled nor
    paired through a join for it.
    """
    facts = staging.credit_snapshots(raw.credit_data)
    dates = snapshot_dates(facts).agg(F.collect_list(F.struct("snapshot_date")).alias("dates"))
    base = customers_with_demographics(raw)
    rows = base.select("*", F.inline(dates.scalar()))
    return rows.withColumns({
        "age_at_snapshot": _age(F.col("snapshot_date")),
        "age_group": bands.age_group(_age(F.col("snapshot_date"))),
        "income_group": bands.income_group(F.col("avg_monthly_income")),
    })


def _credit_with_customer(facts: DataFrame, keys: DataFrame, raw: RawTables, around: DataFrame | None = None) -> DataFrame:
    """``facts`` may carry columns besides those of ``keys``, the facts as staged; ages use each fact's own date.

    Rows ``around`` have no loan id and go around the join.
    """
    sizes = joins.stored_sizes({"fact": keys, **_customer_sides(raw)}, KEY)
    people = customers_with_demographics(raw, sizes).select(
        KEY, *CUSTOMER_COLUMNS, F.col("return_date").alias("customer_return_date"),
        "date_of_birth", "gender", "citizenship", "avg_monthly_income",
        bands.income_group(F.col("avg_monthly_income")).alias("income_group"),
        F.lit(True).alias("_customer"),
    )
    joined = joins.left_join(
        facts, people, KEY, sizes, F.col("has_fact") & ~F.col("has_sale"),
        matchable=F.col("snapshot_date").isNotNull(), left_rows=joins.rows_of("fact"), right_rows=_people_rows(),
    )
    if around is not None:
        joined = joined.unionByName(around, allowMissingColumns=True)
    age, loan, cash = _age(F.col("snapshot_date")), F.col("loan_price"), F.col("cash_price")
    return joined.withColumns({
        "age_at_snapshot": age,
        "age_group": F.when(F.col("_customer"), bands.age_group(age)),
        "financing_markup": money.financing_markup(loan, cash),
        "markup_percentage": money.markup_percentage(loan, cash),
        "account_tenure_days": calendar.days_between(F.col("sale_date"), F.col("snapshot_date")),
        "account_tenure_months": calendar.months_between(F.col("sale_date"), F.col("snapshot_date")),
    })


def _credit_columns(facts: DataFrame) -> list[str]:
    return [
        *facts.columns, *CUSTOMER_COLUMNS, "customer_return_date", "date_of_birth", "age_at_snapshot",
        "age_group", "gender", "citizenship", "avg_monthly_income", "income_group",
        "financing_markup", "markup_percentage", "account_tenure_days", "account_tenure_months",
    ]


def credit_with_customer(raw: RawTables) -> DataFrame:
    """Facts with all matching customer rows (or one row without). Fan-out is kept."""
    facts = staging.credit_snapshots(raw.credit_data)
    return _credit_with_customer(facts, facts, raw).select(*_credit_columns(facts))


def response_order() -> list[Column]:
    """Newest response first."""
    return [F.desc_nulls_last("submitted_at"), F.desc_nulls_last("submission_id")]


def response_rows(responses: DataFrame) -> DataFrame:
    """What the newest response of a loan is chosen from."""
    return responses.select(KEY, "submission_id", *RESPONSE_COLUMNS)


def latest_responses(responses: DataFrame) -> DataFrame:
    """Newest response of each loan, whether or not it carries a score."""
    return latest_per_key(response_rows(responses), KEY, *response_order()).drop("submission_id")


def credit_with_nps(raw: RawTables) -> DataFrame:
    """Facts with customer rows and the newest response.

    The response (one per loan) joins the facts before these fan out; the keys
    and their sizes come from the plain facts, so the top-1 is planned once. Facts without
    a loan id go around both joins, so the first leaves its rows as the second takes them.
    """
    facts = staging.credit_snapshots(raw.credit_data)
    newest = latest_responses(staging.survey(raw.nps_data))
    newest = newest.withColumnRenamed("submitted_at", "nps_submitted_at")
    columns = [c for c in newest.columns if c != KEY]
    answered = staging.survey(raw.nps_data).select(KEY)
    sizes = joins.stored_sizes({"fact": facts, "response": answered}, KEY)
    padded = joins.pad(newest, sizes, F.col("has_fact") & ~F.col("has_response"), KEY)
    known = F.col(KEY).isNotNull()
    with_response = joins.split_join(facts.where(known), padded, KEY, sizes, joins.rows_of("fact"), F.lit(1))
    joined = _credit_with_customer(with_response, facts, raw, around=facts.where(~known))
    return joined.select(*_credit_columns(facts), *columns)
