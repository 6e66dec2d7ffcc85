"""One check query per registered Spark query."""

from __future__ import annotations

from oracle.relations import (
    INCOME_RANK, PAYMENT_PERFORMANCE, age_group, dpd_bucket, income_group, nps_category, us_date, valid, with_relations,
)


def _ids(condition: str, alias: str) -> str:
    return f"count(distinct loan_id) filter (where {condition}) {alias}"


def _share32(part: str, whole: str) -> str:
    return f"cast({part} as float) / cast({whole} as float) * 100"


STATUS_COUNTS = [
    _ids("account_status_l2 = 'Active'", "active_loans"),
    _ids("account_status_l2 = 'FPD'", "fpd_loans"),
    _ids("account_status_l2 = 'Paid Off'", "paid_off_loans"),
    _ids("account_status_l2 = 'Inactive'", "inactive_loans"),
    _ids("balance_due_status = 'up to date'", "up_to_date_count"),
    _ids("balance_due_status = 'Arrears'", "arrears_count"),
    _ids("balance_due_status = 'Advance'", "advance_count"),
]
STATUS_BALANCES = [
    "sum(if(balance_due_status = 'up to date', balance, 0)) up_to_date_balance",
    "sum(if(balance_due_status = 'Arrears', balance, 0)) arrears_balance",
    "sum(if(balance_due_status = 'Arrears', arrears, 0)) total_arrears_amount",
]
DPD_COUNTS = [
    _ids("days_past_due = 0", "dpd_0"),
    _ids("days_past_due between 1 and 30", "dpd_1_30"),
    _ids("days_past_due between 31 and 60", "dpd_31_60"),
    _ids("days_past_due between 61 and 90", "dpd_61_90"),
    _ids("days_past_due > 90", "dpd_90_plus"),
]
PRODUCT_COUNTS = [
    _ids("product_name like '%Galaxy-S%'", "galaxy_s_loans"),
    _ids("product_name like '%Galaxy-A%'", "galaxy_a_loans"),
    _ids("product_name like '%Note%'", "note_loans"),
    _ids("product_name like '%iPhone%'", "iphone_loans"),
    _ids("loan_term = '12M'", "term_12m_loans"),
    _ids("loan_term = '18M'", "term_18m_loans"),
    _ids("loan_term = '24M'", "term_24m_loans"),
    _ids("returned > 0", "returned_devices"),
]
BALANCES = [
    "count(distinct loan_id) total_loans", "sum(balance) total_balance", "sum(total_paid) total_payments",
    "sum(arrears) total_arrears", "avg(days_past_due) avg_days_past_due",
]
RATES = [
    f"if(total_loans > 0, {_share32('arrears_count', 'total_loans')}, cast(0 as float)) arrears_rate_pct",
    f"if(total_loans > 0, {_share32('fpd_loans', 'total_loans')}, cast(0 as float)) fpd_rate_pct",
    f"if(total_loans > 0, {_share32('paid_off_loans', 'total_loans')}, cast(0 as float)) paid_off_rate_pct",
    "if(total_balance > 0, total_arrears_amount / total_balance * 100, 0) arrears_balance_pct",
    "if(total_balance > 0, total_payments / total_balance * 100, 0) payment_collection_pct",
]
MEASURES = [*BALANCES, *STATUS_COUNTS, *STATUS_BALANCES, *DPD_COUNTS, *PRODUCT_COUNTS]


def _portfolio(columns: str, where: str = "") -> str:
    return (
        f"select {columns} from (select *, {', '.join(RATES)} from "
        f"(select snapshot_date, {', '.join(MEASURES)} from joined {where} group by snapshot_date))"
    )


LATEST_ONLY = "where snapshot_date = (select max(snapshot_date) from snap)"
COHORT = f"""select cohort_quarter, cohort_age_quarters, snapshot_date, count(distinct loan_id) cohort_size,
  avg(total_paid) avg_total_paid, avg(balance) avg_balance,
  sum(total_paid) / nullif(sum(total_paid + balance), 0) * 100 avg_repayment_rate_pct,
  {_ids("balance_due_status = 'Arrears'", "arrears_count")},
  {_share32("arrears_count", "cohort_size")} arrears_rate_pct, avg(days_past_due) avg_dpd,
  {_ids("account_status_l2 = 'Active'", "active_count")}, {_ids("account_status_l2 = 'FPD'", "fpd_count")},
  {_ids("account_status_l2 = 'Paid Off'", "paid_off_count")},
  {_ids("account_status_l2 = 'Inactive'", "inactive_count")},
  {_share32("paid_off_count", "cohort_size")} paid_off_rate_pct
from (select *, cast(date_trunc('quarter', sale_date) as date) cohort_quarter,
        datediff('quarter', sale_date, snapshot_date) cohort_age_quarters from joined)
where cohort_quarter is not null group by cohort_quarter, cohort_age_quarters, snapshot_date"""


def _segment(group: str, status: str, rate: str, known: str) -> str:
    return f"""select {group}, count(distinct loan_id) total_loans,
      round(count(distinct loan_id) * 100.0 / sum(count(distinct loan_id)) over (), 1) pct_of_portfolio,
      round(avg(avg_monthly_income), 0) avg_income, round(avg(days_past_due), 1) avg_dpd,
      round(count(*) filter (where balance_due_status = 'Arrears') * 100.0 / count(*), 1) arrears_rate_pct,
      round(count(*) filter (where account_status_l2 = '{status}') * 100.0 / count(*), 1) {rate}
    from latest where {known} group by {group}"""


BANDED = "not in ('Unknown', 'None')"
SEG_AGE = _segment("age_group", "FPD", "fpd_rate_pct", f"age_group {BANDED}")
SEG_INCOME = _segment("income_group", "Paid Off", "paid_off_rate_pct", f"income_group {BANDED}")
SEG_GENDER = _segment("gender", "Paid Off", "paid_off_rate_pct", "gender is not null")


def _extremes(segment: str, report: str, position: str) -> str:
    def pick(measure: str, value: str, order: str) -> str:
        return (
            f"(select '{segment}' segment, '{measure}' measure, {segment} \"label\", {value} \"value\" "
            f"from ({report}) order by {order} limit 1)"
        )

    return " union all ".join([
        pick("largest_segment", "pct_of_portfolio", f"pct_of_portfolio desc, {position}"),
        pick("lowest_arrears_rate", "arrears_rate_pct", f"arrears_rate_pct, {position}"),
        pick("highest_arrears_rate", "arrears_rate_pct", f"arrears_rate_pct desc, {position}"),
        pick("first_arrears_rate", "arrears_rate_pct", position),
        pick("last_arrears_rate", "arrears_rate_pct", f"{position} desc"),
    ])


def _thousands(value: str) -> str:
    return f"format('{{:,}}', {value})"


def _fixed(value: str, digits: int) -> str:
    return f"format('{{:.{digits}f}}', cast({value} as double))"


SCORED_COUNTS = """(select count(*) from scored) scored_loans,
  (select count(distinct loan_id) from snap where snapshot_date = (select max(snapshot_date) from snap)) total_loans"""
NEWEST_RATE = f"select *, scored_loans / total_loans * 100 response_rate_pct from (select {SCORED_COUNTS})"

# Calendar and band checks read the facts or dimensions whole.
STAGED_INCOME = """select loan_id, total_income, avg_monthly_income from (select *, ifnull(received, 0)
  + ifnull(persons_received_total, 0) + ifnull(banks_received, 0) + ifnull(paybills_received_others, 0) total_income,
  if(duration > 0, total_income / duration, null) avg_monthly_income from inc)"""


def _span(unit: str) -> str:
    return f"""select loan_id, snapshot_date, datediff('{unit}', sale_date, snapshot_date) as "{unit}s" from snap"""


def _null_count(model: str, relation: str, column: str) -> str:
    return (
        f"select '{model}' model, '{column}' column_name, count(*) filter (where {column} is null) failing_rows "
        f"from {relation}"
    )


def _na(column: str) -> str:
    return f"if({column} in ('', '#N/A'), null, {column})"


# The second snapshot file is named a day before the date of its rows.
SNAPSHOT_FILE = """case when snapshot_date = date '2000-03-31' then date '2000-03-30' else snapshot_date end"""
SNAPSHOT_TABLE = f"'credit_data_' || strftime({SNAPSHOT_FILE}, '%Y%m%d')"

PLAIN = {
    # staging
    "stg_credit_snapshots": "select * from snap",
    "stg_customers": "select * from cust",
    "stg_customer_demographics": "select * from demo",
    "stg_nps": "select * from resp",
    # row-level joins
    "join_full_outer": "select loan_id, date_of_birth, citizenship, gender from birth full join gend using (loan_id)",
    "join_left_customer_demo": "select * from custdemo",
    "int_customer_enriched": "select * from enriched",
    "int_credit_with_customer": "select * from joined",
    "int_credit_with_nps": "select * from joined_nps",
    "win_latest_nps": "select * from newest",
    "win_latest_snapshot": """select loan_id, snapshot_date, balance, total_paid, arrears, days_past_due,
        balance_due_status, account_status_l2 from snap qualify row_number() over (partition by loan_id
        order by snapshot_date desc, balance, total_paid, arrears, days_past_due, balance_due_status,
        account_status_l2) = 1""",
    "distinct_snapshots": "select distinct snapshot_date from snap",
    "flt_latest_snapshot": """select loan_id, snapshot_date, balance, days_past_due from snap
        where snapshot_date = (select max(snapshot_date) from snap)""",
    "flt_valid_ids": f"""select 'customer_sales' source, count(*) total_rows, count(*) filter (where {valid('"Loan Id"')}) valid_rows
        from customer_sales union all
        select 'customer_dob', count(*), count(*) filter (where {valid('"Loan Id "')}) from customer_dob union all
        select 'customer_gender', count(*), count(*) filter (where {valid('"Loan Id"')}) from customer_gender union all
        select 'customer_income', count(*), count(*) filter (where {valid('"Loan Id"')}) from customer_income""",
    "flt_not_null": """select "Loan Id" loan_id, "Submission ID" submission_id, nps_score from nps_data
        where "Loan Id" is not null and nps_score is not null""",
    # scalar rules over whole tables
    "cln_sentinel_dates": """select loan_id, snapshot_date, return_date, credit_expiry, max_payment_date from snap""",
    "fn_parse_date": "select loan_id, snapshot_date, sale_date, next_invoice_date from snap",
    "fn_casts": """select sale_id, cast(sale_date as date) sale_date, cast(return_date as varchar) return_date_text,
        cast(return_date as date) return_date from customer_sales""",
    "fn_datediff_year": _span("year"),
    "fn_datediff_month": _span("month"),
    "fn_datediff_quarter": _span("quarter"),
    "fn_datediff_day": _span("day"),
    "fn_trunc_quarter": """select loan_id, snapshot_date, cast(date_trunc('quarter', sale_date) as date) sale_quarter,
        cast(date_trunc('quarter', snapshot_date) as date) snapshot_quarter from snap""",
    "fn_tenure": """select loan_id, snapshot_date, datediff('day', sale_date, snapshot_date) account_tenure_days,
        datediff('month', sale_date, snapshot_date) account_tenure_months from snap""",
    "fn_markup": """select sale_id, loan_price - cash_price financing_markup,
        if(cash_price > 0, (loan_price - cash_price) / cash_price * 100, null) markup_percentage from cust""",
    "fn_income": STAGED_INCOME,
    "cohort_assign": """select loan_id, snapshot_date, cast(date_trunc('quarter', sale_date) as date) cohort_quarter,
        datediff('quarter', sale_date, snapshot_date) cohort_age_quarters from snap""",
    "std_gender": "select loan_id, gender from gend",
    "std_citizenship": "select loan_id, citizenship from gend",
    "band_age_group": f"""select loan_id, date_of_birth, {age_group('age')} age_group from
        (select *, datediff('year', date_of_birth, (select max(snapshot_date) from snap)) age from birth)""",
    "band_income_group":
        f"select *, {income_group('avg_monthly_income')} income_group from ({STAGED_INCOME})",
    "band_dpd": f"select loan_id, snapshot_date, days_past_due, {dpd_bucket('days_past_due')} dpd_bucket from snap",
    "band_nps_category": f"""select "Submission ID" submission_id, nps_score, {nps_category('nps_score')} nps_category
        from nps_data""",
    "band_payment_performance": f"""select loan_id, snapshot_date, {PAYMENT_PERFORMANCE} payment_performance
        from snap""",
    # marts and parts of them
    "mart_portfolio_performance": _portfolio("*"),
    "mart_cohort_analysis": COHORT,
    "mart_credit_vs_nps": "select * from scored",
    "agg_balances":
        f"select snapshot_date, {', '.join(BALANCES)} from joined group by snapshot_date",
    "agg_status_balances": f"select snapshot_date, {', '.join(STATUS_BALANCES)} from joined group by snapshot_date",
    "agg_product_mix": f"select snapshot_date, {', '.join(PRODUCT_COUNTS)} from joined group by snapshot_date",
    "agg_rates": _portfolio(
        "snapshot_date, arrears_rate_pct, fpd_rate_pct, paid_off_rate_pct, arrears_balance_pct, payment_collection_pct"
    ),
    "agg_repayment_rate":
        f"select cohort_quarter, cohort_age_quarters, snapshot_date, avg_repayment_rate_pct from ({COHORT})",
    "nps_summary_by_category": f"""select nps_category, count(*) loan_count, avg(nps_score) avg_nps_score,
        avg(days_past_due) avg_dpd, count(*) filter (where balance_due_status = 'Arrears') arrears_count,
        {_share32('arrears_count', 'loan_count')} arrears_rate_pct, avg(balance) avg_balance,
        avg(total_paid) avg_total_paid,
        count(*) filter (where phone_locked_despite_payment = 'Yes') phone_locked_count,
        count(*) filter (where experienced_payment_delay = 'Yes') payment_delay_count,
        count(*) filter (where difficulty_getting_support = 'Yes') support_issues_count
        from scored group by nps_category""",
    "nps_summary_by_payment": """select payment_performance, count(*) loan_count, avg(nps_score) avg_nps_score,
        count(*) filter (where nps_category = 'Promoter') promoters,
        count(*) filter (where nps_category = 'Passive') passives,
        count(*) filter (where nps_category = 'Detractor') detractors,
        (cast(promoters as float) - cast(detractors as float)) / cast(loan_count as float) * 100 nps_score_calculated
        from scored group by payment_performance""",
    # segments
    "seg_age_group": SEG_AGE,
    "seg_income_group": SEG_INCOME,
    "seg_gender": SEG_GENDER,
    "win_pct_of_total": """select gender, count(distinct loan_id) total_loans,
        round(count(distinct loan_id) * 100.0 / sum(count(distinct loan_id)) over (), 1) pct_of_portfolio
        from latest where gender is not null group by gender""",
    "kpi_segment_extremes":
        f"{_extremes('age_group', SEG_AGE, 'age_group')} union all {_extremes('income_group', SEG_INCOME, INCOME_RANK)}",
    "kpi_gender_split": f"""select m.total_loans male_loans,
        round(m.total_loans / (m.total_loans + f.total_loans) * 100, 1) male_share_pct, f.total_loans female_loans,
        round(f.total_loans / (m.total_loans + f.total_loans) * 100, 1) female_share_pct,
        m.arrears_rate_pct male_arrears_rate_pct, f.arrears_rate_pct female_arrears_rate_pct,
        t.gender top_gender, t.pct_of_portfolio top_gender_pct
        from (select * from ({SEG_GENDER}) where gender = 'Male') m,
          (select * from ({SEG_GENDER}) where gender = 'Female') f,
          (select * from ({SEG_GENDER}) order by total_loans desc, gender limit 1) t""",
    # reports
    "rpt_portfolio_trend": _portfolio(
        "snapshot_date, total_loans, total_balance, arrears_rate_pct, fpd_rate_pct, paid_off_rate_pct, "
        "total_balance / 1e6 balance_millions"
    ),
    "rpt_dpd_distribution": " union all ".join(
        f"select snapshot_date, '{label}' dpd_bucket, count(distinct loan_id) filter (where {test}) loans "
        "from joined group by snapshot_date"
        for label, test in [
            ("Current", "days_past_due = 0"), ("1-30 DPD", "days_past_due between 1 and 30"),
            ("31-60 DPD", "days_past_due between 31 and 60"), ("61-90 DPD", "days_past_due between 61 and 90"),
            ("90+ DPD", "days_past_due > 90"),
        ]
    ),
    "kpi_growth": """select first_loans, last_loans, (last_loans / first_loans - 1) * 100 growth_pct from
        (select min_by(n, snapshot_date) first_loans, max_by(n, snapshot_date) last_loans from
          (select snapshot_date, count(distinct loan_id) n from snap group by snapshot_date))""",
    "kpi_write_off_rate": _portfolio(
        "snapshot_date, dpd_90_plus, total_loans, dpd_90_plus / total_loans * 100 dpd_90_plus_pct", LATEST_ONLY
    ),
    "kpi_latest": "select * from ({}) unpivot include nulls (value for metric in ({}))".replace(
        "select *", "select metric, value, case left(metric, 1) when '1' then 'Critical if >10%' "
        "when '2' then 'Early warning indicator' when '3' then 'Portfolio aging trend' "
        "when '4' then 'Likely write-offs' when '5' then 'Success rate' else 'Payment efficiency' end note"
    ).format(
        _portfolio(
            f"""{_fixed('arrears_rate_pct', 2)} || '%' "1. Arrears Rate", {_fixed('fpd_rate_pct', 2)} || '%' "2. FPD Rate",
            {_fixed('avg_days_past_due', 1)} || ' days' "3. Avg Days Past Due",
            {_thousands('dpd_90_plus')} || ' loans' "4. 90+ DPD Count",
            {_fixed('paid_off_rate_pct', 2)} || '%' "5. Paid Off Rate",
            {_fixed('payment_collection_pct', 2)} || '%' "6. Collection Rate" """, LATEST_ONLY),
        """"1. Arrears Rate", "2. FPD Rate", "3. Avg Days Past Due", "4. 90+ DPD Count", "5. Paid Off Rate",
        "6. Collection Rate\"""",
    ),
    "kpi_response_rate": NEWEST_RATE,
    "nps_by_payment_performance": """select payment_performance, count(nps_score) "count",
        round_even(avg(nps_score), 2) avg_nps, round_even(median(nps_score), 2) median_nps
        from scored group by payment_performance""",
    "nps_by_category": """select nps_category, count(nps_score) "count", round_even(avg(nps_score), 1) avg_nps
        from scored group by nps_category""",
    "nps_distribution": """select payment_performance, quantile_cont(nps_score, 0.0) min_score,
        quantile_cont(nps_score, 0.25) q1_score, quantile_cont(nps_score, 0.5) median_score,
        quantile_cont(nps_score, 0.75) q3_score, quantile_cont(nps_score, 1.0) max_score
        from scored group by payment_performance""",
    "summary_metrics": f"""select Metric, "Value" from (select {_thousands('total_loans')} "Total Loans (Latest Snapshot)",
        {_thousands('(select count(distinct loan_id) from cust)')} "Total Unique Customers",
        {_thousands('(select count(*) from snap)')} "Total Credit Snapshot Records",
        {_thousands('scored_loans')} "NPS Survey Responses",
        {_fixed('response_rate_pct', 1)} || '%' "NPS Response Rate (%)" from ({NEWEST_RATE}))
        unpivot ("Value" for Metric in ("Total Loans (Latest Snapshot)", "Total Unique Customers",
        "Total Credit Snapshot Records", "NPS Survey Responses", "NPS Response Rate (%)"))""",
    # quality
    "dq_not_null": " union all ".join([
        _null_count("stg_credit_snapshots", "snap", "loan_id"),
        _null_count("stg_credit_snapshots", "snap", "snapshot_date"),
        _null_count("stg_customers", "cust", "loan_id"),
        _null_count("stg_nps", "resp", "loan_id"),
        _null_count("stg_nps", "resp", "nps_score"),
        _null_count("stg_nps", "resp", "nps_category"),
    ]),
    "dq_unique": """select 'stg_customers' model, 'loan_id' column_name, count(*) failing_rows
        from (select loan_id from cust group by loan_id having count(*) > 1)""",
    "dq_accepted_values": """select 'stg_nps' model, 'nps_score' column_name,
        count(*) filter (where nps_score not between 0 and 10) failing_rows from resp union all
        select 'stg_nps', 'nps_category',
        count(*) filter (where nps_category not in ('Promoter', 'Passive', 'Detractor')) from resp""",
    "dq_staging_counts": """select (select count(*) from cust) stg_customers_rows,
        (select count(distinct loan_id) from demo) demographics_unique_loans""",
    "dq_demographic_coverage": f"""select *, round(with_dob * 100.0 / total_unique_loans, 1) with_dob_pct,
        round(with_gender * 100.0 / total_unique_loans, 1) with_gender_pct,
        round(with_income * 100.0 / total_unique_loans, 1) with_income_pct from
        (select count(distinct loan_id) total_unique_loans, {_ids('date_of_birth is not null', 'with_dob')},
          {_ids('gender is not null', 'with_gender')}, {_ids('avg_monthly_income is not null', 'with_income')}
         from demo)""",
    "dq_band_coverage": f"""select *, round(with_age_group * 100.0 / total_loans, 1) age_group_pct,
        round(with_income_group * 100.0 / total_loans, 1) income_group_pct from
        (select count(distinct loan_id) total_loans, {_ids(f'age_group {BANDED}', 'with_age_group')},
          {_ids(f'income_group {BANDED}', 'with_income_group')} from latest)""",
    "dq_age_distribution": """select age_group, count(distinct loan_id) loan_count,
        round(count(distinct loan_id) * 100.0 / sum(count(distinct loan_id)) over (), 1) pct
        from latest group by age_group""",
    "agg_union_stats": """select count(*) total_rows, count(distinct loan_id) unique_loans,
        count(distinct snapshot_date) snapshot_dates, min(snapshot_date) earliest_snapshot,
        max(snapshot_date) latest_snapshot from snap""",
    "agg_snapshot_breakdown": """select snapshot_date, count(distinct loan_id) unique_loans, count(*) total_records
        from snap group by snapshot_date""",
}

FILES = {
    "src_discover_files": f"""select 'Credit Data - ' || strftime({SNAPSHOT_FILE}, '%d-%m-%Y') stem,
        {SNAPSHOT_TABLE} snapshot_table, count(*) row_count from snap group by all""",
    "src_snapshot_name":
        f"""select loan_id, "date", {SNAPSHOT_TABLE} snapshot_table
        from (select loan_id, "date", {us_date('"date"')} snapshot_date from credit_data)""",
    "src_credit_scan": """select * replace (nullif(return_date, 'None') as return_date,
        nullif(credit_expiry, 'None') as credit_expiry, nullif(max_payment_date, 'None') as max_payment_date)
        from credit_data""",
    "src_sheet_tables": f"""select 'customer_sales' table_name, count(*) row_count,
          count({_na('"Loan Id"')}) loan_ids, sum(loan_price) total from customer_sales
        union all select 'customer_gender', count(*), count("Loan Id"), cast(count(gender) as double)
          from customer_gender
        union all select 'customer_dob', count(*), count("Loan Id "), cast(sum(year(date_of_birth)) as double)
          from customer_dob
        union all select 'customer_income', count(*), count({_na('"Loan Id"')}), sum(received)
          from customer_income""",
    "src_survey": "select * from nps_data",
    "src_optional": """select unnest(['customer_sales', 'customer_dob', 'customer_gender', 'customer_income',
          'nps_data']) table_name, cast(0 as bigint) row_count
        union all select 'credit_data', count(*) from credit_data""",
    "src_load_once": f"""select {SNAPSHOT_TABLE} snapshot_table, cast(1 as bigint) files_loaded,
        cast(if(snapshot_date = date '2000-01-01', 1, 0) as bigint) files_skipped, count(*) row_count
        from snap group by snapshot_date""",
    "src_latest_ingested": """select loan_id, snapshot_date, balance, days_past_due from snap
        where snapshot_date = (select max(snapshot_date) from snap)""",
    "src_missing_cells": "select loan_id, sale_id, sale_date, return_date from cust",
    "cat_row_counts": f"""select {SNAPSHOT_TABLE} table_name, count(*) row_count from snap group by all
        union all select 'customer_sales', count(*) from customer_sales
        union all select 'customer_dob', count(*) from customer_dob
        union all select 'customer_gender', count(*) from customer_gender
        union all select 'customer_income', count(*) from customer_income
        union all select 'nps_data', count(*) from nps_data""",
    "cat_snapshot_tables": f"""select distinct {SNAPSHOT_TABLE} table_name, "date"
        from (select "date", {us_date('"date"')} snapshot_date from credit_data)""",
    "cat_snapshot_counts": f"""select {SNAPSHOT_TABLE} table_name, count(*) row_count,
        (select count(distinct snapshot_date) from snap) tables_detected from snap group by all""",
    "cat_union_snapshots": "select * from snap",
    "sink_mart_table": COHORT,
    "sink_replaced_table": COHORT,
    "mart_portfolio_from_states": _portfolio("*"),
    "mart_cohort_from_states": COHORT,
    "win_latest_snapshot_from_state": PLAIN["win_latest_snapshot"],
    "win_latest_nps_from_state": PLAIN["win_latest_nps"],
    "mart_credit_vs_nps_from_state": PLAIN["mart_credit_vs_nps"],
    "dq_observed_not_null": PLAIN["dq_not_null"],
    "dq_observed_accepted_values": PLAIN["dq_accepted_values"],
    "sink_csv_content": f"""select *, row_number() over (order by cohort_quarter nulls last, snapshot_date nulls last,
        cohort_age_quarters nulls last) as position from ({COHORT})""",
    "sink_export_isolation": """select 'fails_in_python' export, 'SKIP' status, null::bigint "rows", true has_reason
        union all select 'mart_portfolio_performance', 'OK', (select count(distinct snapshot_date) from snap), false
        union all select 'below_a_file/x', 'SKIP', null, true
        union all select 'stg_customers', 'OK', (select count(*) from cust), false""",
    "sink_named_tables": """select unnest(['customer_sales', 'customer_dob', 'customer_gender', 'customer_income', 'nps_data',
          'mart_cohort_analysis']) table_name,
        unnest([(select count(*) from customer_sales), (select count(*) from customer_dob), (select count(*) from customer_gender),
          (select count(*) from customer_income), (select count(*) from nps_data),
          (select count(*) from (select distinct date_trunc('quarter', sale_date), snapshot_date from snap))]) row_count,
        unnest([true, true, true, true, true, false]) kept""",
    "sink_csv_export": """select 'mart_portfolio_performance' export, 'OK' status,
          (select count(distinct snapshot_date) from snap) "rows"
        union all select 'mart_credit_vs_nps', 'OK', (select count(*) from scored)
        union all select 'mart_cohort_analysis', 'OK', (select count(*) from (
          select distinct date_trunc('quarter', sale_date), snapshot_date from snap))
        union all select 'stg_customers', 'OK', (select count(*) from cust)
        union all select 'SUMMARY', 'OK', 5""",
}
FILES["src_mixed_headers"] = FILES["src_credit_scan"]


def oracle_sql() -> dict[str, str]:
    return {name: with_relations(query) for name, query in {**PLAIN, **FILES}.items()}
