"""Loan-book inputs derived from the ``orders`` and ``events`` tables.

One text serves both engines; only the quoting of names differs, and the way an
order is repeated for every snapshot it existed at.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

# Snapshot number, date, and name of the physical snapshot table.
# The second table is named a day before the date its rows carry.
SNAPSHOTS = (
    (0, "2000-01-01", "credit_data_20000101"),
    (1, "2000-03-31", "credit_data_20000330"),
    (2, "2000-06-30", "credit_data_20000630"),
    (3, "2000-09-30", "credit_data_20000930"),
    (4, "2000-12-30", "credit_data_20001230"),
)

CREDIT_DATA = """
select concat('L',cast(k as string)) loan_id,
  concat(cast(month(s) as string),'/',cast(day(s) as string),'/',cast(year(s) as string)) "date",
  k%700 customer_age,
  cast((k*37)%40000+q*1500 as double) total_paid,
  cast((k*7)%3000 as double) total_due_today,
  cast((k*53)%50000 as double) balance,
  case when k%97=0 then null when k%5<3 then 0 else (k*17+q*29)%131 end days_past_due,
  cast((k*53)%50000 as double) closing_balance,
  cast((k*3)%500 as double) advance,
  cast((k*19)%8000 as double) balance_due_to_date,
  case when k%5<3 then 0.0e0 else cast((k*11)%9000 as double) end arrears,
  case when k%7=0 then 'Advance' when k%7<3 then 'up to date' when k%7<6 then 'Arrears' else 'Paid Off' end balance_due_status,
  cast((k*5)%4000 as double) payment,
  cast((k*6)%4000 as double) expected_payment,
  cast((k*9)%4000 as double) first_payment,
  cast((k*10)%4000 as double) first_expected_payment,
  case when k%3=0 then 'Closed' else 'Open' end account_status_l1,
  case when (k+q)%5=0 then 'FPD' when (k+q)%5=1 then 'Paid Off' when (k+q)%5=2 then 'Inactive' when (k+q)%5=3 then 'Default' else 'Active' end account_status_l2,
  case when k%9=0 then concat(cast(month(s) as string),'/',cast(day(s) as string),'/',cast(year(s) as string)) else 'None' end return_date,
  concat(cast(month(d) as string),'/',cast(day(d) as string),'/',cast(year(d) as string)) sale_date,
  case when k%2=0 then 'Yes' else 'No' end credit_check_done,
  cast((k*5)%4000 as double) payment_amount,
  cast((k*1)%200 as double) adjustment_amount,
  cast((k*2)%300 as double) prepayment_amount,
  cast((k*29)%12000 as double) deposit,
  cast((k*23)%1500 as double) weekly_rate,
  case when k%10=0 then 'None' else concat(cast(month(s) as string),'/',cast(day(s) as string),'/',cast(year(s) as string)) end credit_expiry,
  concat(cast(month(s) as string),'/',cast(day(s) as string),'/',cast(year(s) as string)) next_invoice_date,
  cast((k*1)%50 as double) discount,
  cast((k*1)%70 as double) overpayment_amount,
  case when k%12=0 then 'None' else concat(cast(month(d) as string),'/',cast(day(d) as string),'/',cast(year(d) as string)) end max_payment_date,
  cast((k*29)%12000 as double) initial_pay,
  cast((k*37)%40000+q*1500 as double) total_paid_with_adjustments_15d
from {orders_by_snapshot}
"""

SALES_ROWS = """
select case when k%50=0 then null when k%50=1 then '' when k%50=2 then '#N/A' else concat('L',cast(k as string)) end "Loan Id", k sale_id, d sale_date,
  case when k%9=0 then 1 else 0 end returned,
  case when k%9=0 then d else null end return_date,
  case when k%2=0 then 'Credit' else 'Cash' end sale_type,
  concat('S',cast(k%40 as string)) seller,
  case when k%4=0 then 'Agent' else 'Shop' end seller_type,
  case when k%9=0 then 'Yes' else 'No' end return_policy_compliance,
  case when k%101=0 then 0.0e0 else cast(5000+(k*41)%60000 as double) end cash_price,
  cast(5000+(k*41)%60000+k%7000 as double) loan_price,
  case when k%6=0 then 'New' else 'Repeat' end client_model,
  case when k%8=0 then 'B2B' else 'B2C' end business_model,
  case when k%4=0 then '12M' when k%4=1 then '18M' when k%4=2 then '24M' else '6M' end loan_term,
  case when k%5=0 then 'Galaxy-S22' when k%5=1 then 'Galaxy-A14' when k%5=2 then 'Redmi Note 12' when k%5=3 then 'iPhone 11' else 'Pixel 6' end product_name,
  concat('M',cast(k%17 as string)) model
from (select o_orderkey k, cast(o_orderdate as date) d from orders) o
"""

# Every 400th sale is listed twice.
CUSTOMER_SALES = SALES_ROWS + "union all" + SALES_ROWS.rstrip() + " where k%400=3\n"

CUSTOMER_DOB = """
select case when k%50=0 then null when k%50=1 then '' when k%50=2 then '#N/A' else concat('L',cast(k as string)) end "Loan Id ",
  make_date(cast(1930+k%60 as int), cast(1+k%12 as int), cast(1+k%28 as int)) date_of_birth
from (select o_orderkey k from orders) o where k%7<>0
"""

CUSTOMER_GENDER = """
select case when k%50=0 then null when k%50=1 then '' when k%50=2 then '#N/A' else concat('L',cast(k as string)) end "Loan Id",
  case when k%6=0 then 'M' when k%6=1 then ' Male ' when k%6=2 then 'FEMALE' when k%6=3 then 'f' when k%6=4 then 'Other' else null end gender,
  case when k%8<4 then 'KENYAN' when k%8=4 then ' citizen' when k%8=5 then 'Kenyan' else 'UGANDAN' end citizenship
from (select o_orderkey k from orders) o where k%4<>1
"""

CUSTOMER_INCOME = """
select case when k%50=0 then null when k%50=1 then '' when k%50=2 then '#N/A' else concat('L',cast(k as string)) end "Loan Id",
  case when k%11=0 then 0 when k%13=0 then null else 1+k%12 end duration,
  case when k%10=0 then null else cast((k*97)%400000 as double) end received,
  cast((k*31)%90000 as double) "Persons Received From Total",
  cast((k*17)%50000 as double) "Banks Received",
  case when k%4=0 then null else cast((k*7)%30000 as double) end "Paybills Received Others"
from (select o_orderkey k from orders) o where k%14<>1 and k%14<>2
union all
select concat('L',cast(o_orderkey as string)), 7,
  case when o_orderkey%28=1 then 69997.0e0 else cast(o_orderkey%3000 as double) end, 0.0e0, 0.0e0, null
from orders where (o_orderkey%14=1 or o_orderkey%28=3) and o_orderkey%50>2
"""

NPS_DATA = """
select case when event_id%40=0 then null else concat('L',cast(cast((event_id-event_id%3)/3*4 as bigint) as string)) end "Loan Id",
  event_id "Submission ID", user_id "Respondent ID", ts "Submitted at",
  case when (event_id*31+7)%12=11 then null else (event_id*31+7)%12 end nps_score,
  event_type nps_reason, props improvement_suggestion,
  case when event_id%2=0 then 'Yes' when event_id%7=0 then null else 'No' end happy_with_device_quality,
  case when event_id%5=0 then 'Yes' when event_id%11=0 then null else 'No' end happy_with_service,
  case when event_id%3=0 then 'Yes' when event_id%7=0 then null else 'No' end experienced_payment_delay,
  case when event_id%4=0 then 'Yes' when event_id%9=0 then null else 'No' end difficulty_getting_support,
  case when event_id%6=0 then 'Yes' when event_id%13=0 then null else 'No' end battery_issues,
  case when event_id%2=0 then 'Yes' when event_id%5=0 then null else 'No' end app_usage,
  event_type preferred_channel,
  case when event_id%5=0 then 'Yes' when event_id%8=0 then null else 'No' end phone_locked_despite_payment,
  props additional_feedback
from events
"""

TABLES = {
    "credit_data": CREDIT_DATA, "customer_sales": CUSTOMER_SALES, "customer_dob": CUSTOMER_DOB,
    "customer_gender": CUSTOMER_GENDER, "customer_income": CUSTOMER_INCOME, "nps_data": NPS_DATA,
}


class RawTables:
    """The six raw inputs of the pipeline, each built when first asked for."""

    def __init__(self, **suppliers: Callable[[], DataFrame]):
        if suppliers.keys() != TABLES.keys():
            raise TypeError(f"expected exactly the tables {', '.join(TABLES)}")
        self._suppliers = suppliers

    def __getattr__(self, table: str) -> DataFrame:
        if table not in TABLES:
            raise AttributeError(table)
        df = self._suppliers[table]()
        setattr(self, table, df)
        return df


def ansi_sql(table: str) -> str:
    """The derivation with double-quoted names and a join against the snapshot list."""
    snapshots = " union all ".join(f"select {q} q, cast('{day}' as date) s" for q, day, _ in SNAPSHOTS)
    orders = (
        "(select o_orderkey k, cast(o_orderdate as date) d from orders) o "
        f"join ({snapshots}) sn on o.d <= sn.s"
    )
    return TABLES[table].replace("{orders_by_snapshot}", orders)


def spark_sql(table: str) -> str:
    """The derivation for Spark: snapshots come from an inlined array, so nothing is joined.

    Orders after the last snapshot are in none, so they are not repeated for each first.
    """
    snapshots = ", ".join(f"struct({q} as q, date'{day}' as s)" for q, day, _ in SNAPSHOTS)
    last = max(day for _, day, _ in SNAPSHOTS)
    orders = (
        "(select k, d, sn.q, sn.s from (select o_orderkey k, cast(o_orderdate as date) d, "
        f"explode(array({snapshots})) sn from {{orders}} where cast(o_orderdate as date) <= date'{last}') where d <= sn.s)"
    )
    text = TABLES[table].replace("{orders_by_snapshot}", orders)
    text = re.sub(r'"([^"]+)"', r"`\1`", text)
    return re.sub(r"\bfrom (orders|events)\b", r"from {\1}", text)


# Columns the derivations use.
SOURCES = {
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "events": "event_id bigint, user_id bigint, ts timestamp_ntz, event_type string, props string",
}


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    def derive(table: str) -> DataFrame:
        text = spark_sql(table)
        source = next(name for name in SOURCES if f"{{{name}}}" in text)
        rows = spark.read.schema(SOURCES[source]).parquet(f"{sf_dir}/{source}.parquet")
        return spark.sql(text, **{source: rows})

    return RawTables(**{table: partial(derive, table) for table in TABLES})
