"""Declared schemas of the raw tables. Nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"str": T.StringType(), "dbl": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(),
          "date": T.DateType(), "ts": T.TimestampNTZType()}


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# Columns of one credit snapshot, in file order.
CREDIT = _struct([
    ("loan_id", "str"), ("date", "str"), ("customer_age", "long"), ("total_paid", "dbl"),
    ("total_due_today", "dbl"), ("balance", "dbl"), ("days_past_due", "long"),
    ("closing_balance", "dbl"), ("advance", "dbl"), ("balance_due_to_date", "dbl"),
    ("arrears", "dbl"), ("balance_due_status", "str"), ("payment", "dbl"),
    ("expected_payment", "dbl"), ("first_payment", "dbl"), ("first_expected_payment", "dbl"),
    ("account_status_l1", "str"), ("account_status_l2", "str"), ("return_date", "str"),
    ("sale_date", "str"), ("credit_check_done", "str"), ("payment_amount", "dbl"),
    ("adjustment_amount", "dbl"), ("prepayment_amount", "dbl"), ("deposit", "dbl"),
    ("weekly_rate", "dbl"), ("credit_expiry", "str"), ("next_invoice_date", "str"),
    ("discount", "dbl"), ("overpayment_amount", "dbl"), ("max_payment_date", "str"),
    ("initial_pay", "dbl"), ("total_paid_with_adjustments_15d", "dbl"),
])
CREDIT_RENAMES = {"date": "snapshot_date", "customer_age": "account_age_days"}
CREDIT_DATES = ("date", "sale_date", "next_invoice_date")
CREDIT_OPTIONAL_DATES = ("return_date", "credit_expiry", "max_payment_date")

# Customer workbook sheets.
SALES = _struct([
    ("Loan Id", "str"), ("sale_id", "long"), ("sale_date", "date"), ("returned", "int"),
    ("return_date", "date"), ("sale_type", "str"), ("seller", "str"), ("seller_type", "str"),
    ("return_policy_compliance", "str"), ("cash_price", "dbl"), ("loan_price", "dbl"),
    ("client_model", "str"), ("business_model", "str"), ("loan_term", "str"),
    ("product_name", "str"), ("model", "str"),
])
SALES_RENAMES = {"Loan Id": "loan_id", "model": "product_model"}
DOB = _struct([("Loan Id ", "str"), ("date_of_birth", "date")])
GENDER = _struct([("Loan Id", "str"), ("gender", "str"), ("citizenship", "str")])
INCOME = _struct([
    ("Loan Id", "str"), ("duration", "long"), ("received", "dbl"),
    ("Persons Received From Total", "dbl"), ("Banks Received", "dbl"),
    ("Paybills Received Others", "dbl"),
])
INCOME_RENAMES = {
    "Loan Id": "loan_id", "Persons Received From Total": "persons_received_total",
    "Banks Received": "banks_received", "Paybills Received Others": "paybills_received_others",
}
INCOME_PARTS = ("received", "persons_received_total", "banks_received", "paybills_received_others")

# Satisfaction survey, canonical headers.
SURVEY = _struct([
    ("Loan Id", "str"), ("Submission ID", "long"), ("Respondent ID", "long"), ("Submitted at", "ts"),
    ("nps_score", "long"), ("nps_reason", "str"), ("improvement_suggestion", "str"),
    ("happy_with_device_quality", "str"), ("happy_with_service", "str"),
    ("experienced_payment_delay", "str"), ("difficulty_getting_support", "str"),
    ("battery_issues", "str"), ("app_usage", "str"), ("preferred_channel", "str"),
    ("phone_locked_despite_payment", "str"), ("additional_feedback", "str"),
])
SURVEY_RENAMES = {
    "Loan Id": "loan_id", "Submission ID": "submission_id", "Respondent ID": "respondent_id",
    "Submitted at": "submitted_at",
}
# Question texts as they head the survey export.
SURVEY_QUESTIONS = {
    "nps_score": "Using a scale from 0 (not likely) to 10 (very likely), how likely are you to "
                 "recommend {brand} to friends or family?",
    "nps_reason": "What is the main reason for your score?",
    "improvement_suggestion": "What is one thing we could do to improve your experience with us?",
    "happy_with_device_quality": "Are you happy with the quality and performance of your {brand} device?",
    "happy_with_service": "Are you happy with the service and support provided by {brand}?",
    "experienced_payment_delay": "Have you ever experienced a delay in your payment reflecting in your "
                                 "{account_brand} account?",
    "difficulty_getting_support": "Have you ever had difficulty getting assistance from {brand} customer "
                                  "support when needed?",
    "battery_issues": "Have you experienced any battery-related issues with your {brand} device?",
    "app_usage": "Have you used the {brand} app ({app}) to manage your account or make payments?",
    "preferred_channel": "Which communication channel do you prefer when contacting {brand} for inquiries "
                         "or support?",
    "phone_locked_despite_payment": "Have you ever had your phone lock despite making a payment on time?",
    "additional_feedback": "Any other Feedback?",
}


def survey_headers(brand: str, app: str, account_brand: str | None = None) -> dict[str, str]:
    """Question text → canonical column, for a survey export of the given brand.

    ``account_brand`` is the spelling used in the account question, where it differs.
    """
    names = {"brand": brand, "app": app, "account_brand": account_brand or brand}
    return {text.format(**names): column for column, text in SURVEY_QUESTIONS.items()}


SHEETS = {
    "Sales Details": ("customer_sales", SALES),
    "Gender": ("customer_gender", GENDER),
    "DOB": ("customer_dob", DOB),
    "Income Level": ("customer_income", INCOME),
}
RAW_TABLES = {
    "credit_data": CREDIT, "customer_sales": SALES, "customer_dob": DOB,
    "customer_gender": GENDER, "customer_income": INCOME, "nps_data": SURVEY,
}
