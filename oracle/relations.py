"""Shared relations of the check queries, written as plain joins over whole tables.

They follow the row-level definitions (customers × snapshots, joined rows,
direct distinct counts), so the pre-aggregated Spark plans are checked against
an independent form.
"""

from __future__ import annotations

import re

from loanscope.sources import derived


# Fixed values, stated here a second time so that a wrong edge in the engine shows.
def age_group(age: str) -> str:
    return f"""(case when {age} between 18 and 25 then '18-25' when {age} between 26 and 35 then '26-35'
      when {age} between 36 and 45 then '36-45' when {age} between 46 and 55 then '46-55'
      when {age} > 55 then 'Above 55' else 'Unknown' end)"""


def income_group(income: str) -> str:
    return f"""(case when {income} < 5000 then 'Below 5,000' when {income} between 5000 and 9999 then '5,000-9,999'
      when {income} between 10000 and 19999 then '10,000-19,999' when {income} between 20000 and 29999 then '20,000-29,999'
      when {income} between 30000 and 49999 then '30,000-49,999' when {income} between 50000 and 99999 then '50,000-99,999'
      when {income} between 100000 and 149999 then '100,000-149,999' when {income} >= 150000 then '150,000 and above'
      else 'Unknown' end)"""


INCOME_RANK = """list_position(['Below 5,000', '5,000-9,999', '10,000-19,999', '20,000-29,999', '30,000-49,999',
  '50,000-99,999', '100,000-149,999', '150,000 and above'], income_group)"""


def dpd_bucket(days: str) -> str:
    return f"""(case when {days} = 0 then 'Current' when {days} between 1 and 30 then '1-30 DPD'
      when {days} between 31 and 60 then '31-60 DPD' when {days} between 61 and 90 then '61-90 DPD' else '90+ DPD' end)"""


def nps_category(score: str) -> str:
    return f"(case when {score} >= 9 then 'Promoter' when {score} >= 7 then 'Passive' else 'Detractor' end)"


PAYMENT_PERFORMANCE = """(case when balance_due_status = 'Advance' then 'Excellent'
  when balance_due_status = 'up to date' then 'Good' when arrears > 0 and days_past_due <= 30 then 'Fair'
  when arrears > 0 and days_past_due > 30 then 'Poor' else 'Unknown' end)"""


def us_date(column: str, optional: bool = False) -> str:
    text = f"nullif({column}, 'None')" if optional else column
    return f"cast(strptime({text}, '%m/%d/%Y') as date)"


def valid(column: str) -> str:
    return f"{column} is not null and {column} not in ('', '#N/A')"


RELATIONS = {name: derived.ansi_sql(name) for name in derived.TABLES}
RELATIONS.update(
    snap=f"""select * exclude ("date", customer_age, sale_date, next_invoice_date, return_date, credit_expiry,
        max_payment_date), {us_date('"date"')} snapshot_date, customer_age account_age_days,
      {us_date('sale_date')} sale_date, {us_date('next_invoice_date')} next_invoice_date,
      {us_date('return_date', True)} return_date, {us_date('credit_expiry', True)} credit_expiry,
      {us_date('max_payment_date', True)} max_payment_date from credit_data""",
    cust=f"""select "Loan Id" loan_id, * exclude ("Loan Id", model), model product_model
      from customer_sales where {valid('"Loan Id"')}""",
    birth=f"""select "Loan Id " loan_id, date_of_birth from customer_dob where {valid('"Loan Id "')}""",
    gend=f"""select "Loan Id" loan_id,
        if(upper(trim(citizenship)) in ('KENYAN', 'CITIZEN'), 'Kenyan', citizenship) citizenship,
        case when upper(trim(gender)) in ('M', 'MALE') then 'Male'
          when upper(trim(gender)) in ('F', 'FEMALE') then 'Female' else gender end gender
      from customer_gender where {valid('"Loan Id"')}""",
    inc=f"""select "Loan Id" loan_id, duration, received, "Persons Received From Total" persons_received_total,
        "Banks Received" banks_received, "Paybills Received Others" paybills_received_others
      from customer_income where {valid('"Loan Id"')}""",
    demo="""select loan_id, date_of_birth, citizenship, gender, inc.* exclude (loan_id),
        ifnull(received, 0) + ifnull(persons_received_total, 0) + ifnull(banks_received, 0)
          + ifnull(paybills_received_others, 0) total_income,
        if(duration > 0, total_income / duration, null) avg_monthly_income
      from birth full join gend using (loan_id) full join inc using (loan_id)""",
    resp=f"""select "Loan Id" loan_id, "Submission ID" submission_id, "Respondent ID" respondent_id,
        "Submitted at" submitted_at, n.* exclude ("Loan Id", "Submission ID", "Respondent ID", "Submitted at"),
        {nps_category('nps_score')} nps_category
      from nps_data n where "Loan Id" is not null""",
    custdemo="""select c.*, date_of_birth, citizenship, gender, duration, avg_monthly_income, total_income
      from cust c left join demo using (loan_id)""",
    enriched=f"""select c.*, dates.snapshot_date, datediff('year', date_of_birth, dates.snapshot_date) age_at_snapshot,
        {age_group("age_at_snapshot")} age_group, {income_group("avg_monthly_income")} income_group
      from custdemo c, (select distinct snapshot_date from snap) dates""",
    joined="""select s.*, product_name, product_model, loan_term, business_model, client_model, seller, seller_type,
        cash_price, loan_price, returned, e.return_date customer_return_date, date_of_birth, age_at_snapshot,
        age_group, gender, citizenship, avg_monthly_income, income_group,
        loan_price - cash_price financing_markup,
        if(cash_price > 0, (loan_price - cash_price) / cash_price * 100, null) markup_percentage,
        datediff('day', s.sale_date, s.snapshot_date) account_tenure_days,
        datediff('month', s.sale_date, s.snapshot_date) account_tenure_months
      from snap s left join enriched e on e.loan_id = s.loan_id and e.snapshot_date = s.snapshot_date""",
    latest="select * from joined where snapshot_date = (select max(snapshot_date) from snap)",
    newest="""select loan_id, nps_score, nps_category, submitted_at, happy_with_device_quality, happy_with_service,
        experienced_payment_delay, difficulty_getting_support, battery_issues, phone_locked_despite_payment
      from resp qualify row_number() over (partition by loan_id order by submitted_at desc, submission_id desc) = 1""",
    joined_nps="""select j.*, n.* exclude (loan_id, submitted_at), n.submitted_at nps_submitted_at
      from joined j left join newest n on n.loan_id = j.loan_id""",
    scored=f"""select loan_id, snapshot_date, nps_score, nps_category, balance, total_paid, arrears, days_past_due,
        balance_due_status, account_status_l2, happy_with_device_quality, happy_with_service,
        experienced_payment_delay, difficulty_getting_support, battery_issues, phone_locked_despite_payment,
        product_name, loan_term, {dpd_bucket('days_past_due')} dpd_bucket,
        {PAYMENT_PERFORMANCE} payment_performance
      from (select * from joined_nps qualify row_number() over (partition by loan_id order by snapshot_date desc,
              balance, total_paid, arrears, days_past_due, balance_due_status, account_status_l2,
              product_name, loan_term) = 1)
      where nps_score is not null""",
)


def with_relations(query: str) -> str:
    """Prefix a query with the relations it mentions, directly or through others."""
    needed: set[str] = set()
    pending = [query]
    while pending:
        text = pending.pop()
        for name in RELATIONS.keys() - needed:
            if re.search(rf"\b(from|join|,)\s+{name}\b", text):
                needed.add(name)
                pending.append(RELATIONS[name])
    if not needed:
        return query
    parts = [f"{name} as ({RELATIONS[name]})" for name in RELATIONS if name in needed]
    return f"with {', '.join(parts)} {query}"
