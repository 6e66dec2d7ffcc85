"""Band edges, calendar boundaries, cleaning and rate rules."""

from __future__ import annotations

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from loanscope.functions import bands, calendar, cleaning, money


def apply(spark, kind, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(rule(F.col("v")).alias("r")).collect()]


def test_age_group_edges(spark):
    ages = [None, -1, 17, 18, 25, 26, 35, 36, 45, 46, 55, 56, 90]
    assert apply(spark, "bigint", bands.age_group, ages) == [
        "Unknown", "Unknown", "Unknown", "18-25", "18-25", "26-35", "26-35", "36-45", "36-45", "46-55",
        "46-55", "Above 55", "Above 55",
    ]


def test_income_group_edges_and_gaps(spark):
    incomes = [None, -5.0, 0.0, 4999.99, 5000.0, 9999.0, 9999.57, 10000.0, 19999.0, 19999.5, 20000.0, 29999.0,
               30000.0, 49999.0, 49999.1, 50000.0, 99999.0, 100000.0, 149999.0, 149999.5, 150000.0]
    assert apply(spark, "double", bands.income_group, incomes) == [
        "Unknown", "Below 5,000", "Below 5,000", "Below 5,000", "5,000-9,999", "5,000-9,999", "Unknown",
        "10,000-19,999", "10,000-19,999", "Unknown", "20,000-29,999", "20,000-29,999", "30,000-49,999",
        "30,000-49,999", "Unknown", "50,000-99,999", "50,000-99,999", "100,000-149,999", "100,000-149,999",
        "Unknown", "150,000 and above",
    ]


def test_income_rank(spark):
    labels = ["Below 5,000", "150,000 and above", "Unknown", None]
    assert apply(spark, "string", bands.income_rank, labels) == [1, 8, None, None]


def test_dpd_bucket_edges(spark):
    days = [0.0, 1.0, 30.0, 30.5, 31.0, 60.0, 61.0, 90.0, 91.0, -1.0, None]
    assert apply(spark, "double", bands.dpd_bucket, days) == [
        "Current", "1-30 DPD", "1-30 DPD", "90+ DPD", "31-60 DPD", "31-60 DPD", "61-90 DPD", "61-90 DPD",
        "90+ DPD", "90+ DPD", "90+ DPD",
    ]


def test_nps_category_edges(spark):
    assert apply(spark, "bigint", bands.nps_category, [0, 6, 7, 8, 9, 10, None]) == [
        "Detractor", "Detractor", "Passive", "Passive", "Promoter", "Promoter", "Detractor",
    ]


def test_payment_performance(spark):
    rows = [("up to date", 5.0, 40), ("Advance", 5.0, 40), ("Arrears", 5.0, 30), ("Arrears", 5.0, 31),
            ("Arrears", 0.0, 31), ("Arrears", 5.0, None), (None, 5.0, 3), ("Paid Off", None, 3)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, a double, d bigint")
    rule = bands.payment_performance(F.col("s"), F.col("a"), F.col("d")).alias("r")
    assert [r.r for r in df.orderBy("i").select(rule).collect()] == [
        "Good", "Excellent", "Fair", "Poor", "Unknown", "Unknown", "Fair", "Unknown",
    ]


@pytest.mark.parametrize(("start", "end", "years", "quarters", "months", "days"), [
    ("2000-12-31", "2001-01-01", 1, 1, 1, 1),
    ("2000-01-31", "2000-02-01", 0, 0, 1, 1),
    ("2000-03-31", "2000-04-01", 0, 1, 1, 1),
    ("2000-01-01", "2000-12-31", 0, 3, 11, 365),
    ("2001-01-01", "2000-12-31", -1, -1, -1, -1),
])
def test_boundary_differences(spark, start, end, years, quarters, months, days):
    df = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "a date, b date")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        calendar.years_between(a, b), calendar.quarters_between(a, b), calendar.months_between(a, b),
        calendar.days_between(a, b),
    ).first()
    assert tuple(row) == (years, quarters, months, days)


def test_quarter_start_is_a_date(spark):
    assert apply(spark, "date", calendar.quarter_start, [dt.date(2025, 5, 17)]) == [dt.date(2025, 4, 1)]


def dates(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(cleaning.parse_optional_us_date("v", **options)).collect()]


def test_us_dates(spark):
    assert dates(spark, ["1/5/2025", "01/05/2025", "12/31/1999", "None", None]) == [
        dt.date(2025, 1, 5), dt.date(2025, 1, 5), dt.date(1999, 12, 31), None, None,
    ]


@pytest.mark.parametrize(
    "text", ["2025-01-05", "13/1/2025", "2/30/2025", "1/5/25", "1/5", "1/5/7/2025", "x/5/2025", "", "NaT"]
)
def test_bad_dates_fail_unless_lenient(spark, text):
    with pytest.raises(Exception):
        dates(spark, [text])
    assert dates(spark, [text], lenient=True) == [None]


def test_cell_dates(spark):
    assert apply(spark, "string", cleaning.cell_to_date, ["2025-01-05", "2025-01-05 10:00:00", "NaT", None]) == [
        dt.date(2025, 1, 5), dt.date(2025, 1, 5), None, None,
    ]


def test_standard_labels(spark):
    raw = ["M", " male ", "MALE", "f", "Female", "Other", "", None]
    assert apply(spark, "string", cleaning.standard_gender, raw) == [
        "Male", "Male", "Male", "Female", "Female", "Other", "", None,
    ]
    assert apply(spark, "string", cleaning.standard_citizenship, ["KENYAN", " citizen", "Kenyan", "UGANDAN", None]) \
        == ["Kenyan", "Kenyan", "Kenyan", "UGANDAN", None]


def test_valid_ids(spark):
    assert apply(spark, "string", cleaning.is_valid_id, ["L1", "", "#N/A", None, " "]) == [
        True, False, False, False, True,
    ]


def test_nan_becomes_null(spark):
    assert apply(spark, "double", cleaning.nan_to_null, [float("nan"), 1.5, None]) == [None, 1.5, None]


def float32(value):
    return struct.unpack("f", struct.pack("f", value))[0]


def test_rates(spark):
    df = spark.createDataFrame([(10, 29), (1, 3), (0, 5), (3, 0)], "part bigint, total bigint")
    part, total = F.col("part"), F.col("total")
    narrow = df.select(money.rate32(part, total).alias("r"))
    assert dict(narrow.dtypes)["r"] == "float"
    assert [r.r for r in narrow.collect()] == [float32(34.482758), float32(33.333336), 0.0, 0.0]
    assert [r.r for r in df.select(money.rate(part, total).alias("r")).collect()][2:] == [0.0, 0.0]


def test_income_rules(spark):
    df = spark.createDataFrame(
        [(10.0, None, 5.0, 2), (None, None, None, 0), (9.0, 1.0, 2.0, None)], "a double, b double, c double, n bigint"
    )
    total = money.total_income(F.col("a"), F.col("b"), F.col("c"))
    rows = df.select(total.alias("t"), money.monthly_income(total, F.col("n")).alias("m")).collect()
    assert [tuple(r) for r in rows] == [(15.0, 7.5), (0.0, None), (12.0, None)]


def test_markup(spark):
    df = spark.createDataFrame([(150.0, 100.0), (150.0, 0.0), (None, 100.0)], "loan double, cash double")
    loan, cash = F.col("loan"), F.col("cash")
    rows = df.select(money.financing_markup(loan, cash), money.markup_percentage(loan, cash)).collect()
    assert [tuple(r) for r in rows] == [(50.0, 50.0), (150.0, None), (None, None)]


def test_fixed_text(spark):
    assert apply(spark, "double", lambda c: money.fixed(c, 2), [56.92315, 0.125, 100.0]) == ["56.92", "0.12", "100.00"]
    assert apply(spark, "bigint", money.thousands, [20742, 7]) == ["20,742", "7"]
