"""Named queries over the derived raw tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loanscope import pipeline
from loanscope.functions import bands, calendar, cleaning, money
from loanscope.operators import joins
from loanscope.operators.shares import percent_of_total
from loanscope.plans import enrich, marts, quality, reports, segments, staging, states
from loanscope.plans.staging import KEY
from loanscope.session import configure
from loanscope.sinks import export, tables
from loanscope.sources import catalog, files, sample_files, schemas
from loanscope.sources.derived import RawTables, raw_tables
from loanscope.sources.scratch import scratch_dir
from loanscope.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]


def _facts(raw: RawTables) -> DataFrame:
    return staging.credit_snapshots(raw.credit_data)


def _on_facts(**rules: Callable[[], Column]) -> Callable[[RawTables], DataFrame]:
    """Named column rules over every fact row."""
    return lambda raw: _facts(raw).select(
        KEY, "snapshot_date", *(rule().alias(name) for name, rule in rules.items())
    )


def _tenure(rule: Callable[[Column, Column], Column]) -> Callable[[], Column]:
    return lambda: rule(F.col("sale_date"), F.col("snapshot_date"))


def _parts(mart: Callable[[RawTables], DataFrame], *columns: str) -> Callable[[RawTables], DataFrame]:
    return lambda raw: mart(raw).select(*columns)


def _valid_ids(raw: RawTables) -> DataFrame:
    columns = {
        "customer_sales": "Loan Id", "customer_dob": "Loan Id ",
        "customer_gender": "Loan Id", "customer_income": "Loan Id",
    }
    counted = [
        getattr(raw, table).agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count_if(cleaning.is_valid_id(F.col(f"`{column}`"))).alias("valid_rows"),
        ).select(F.lit(table).alias("source"), "total_rows", "valid_rows")
        for table, column in columns.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def _full_outer(raw: RawTables) -> DataFrame:
    sides = staging.demographic_sides(raw)
    return joins.full_join({name: sides[name] for name in ("dob", "gender")}, KEY)


def _dpd(raw: RawTables) -> DataFrame:
    return _facts(raw).select(KEY, "snapshot_date", "days_past_due",
                              bands.dpd_bucket(F.col("days_past_due")).alias("dpd_bucket"))


def _age_bands(raw: RawTables) -> DataFrame:
    age = calendar.years_between(F.col("date_of_birth"), staging.latest_snapshot(_facts(raw)))
    return staging.births(raw.customer_dob).select(
        KEY, "date_of_birth", bands.age_group(age).alias("age_group")
    )


def _income_bands(raw: RawTables) -> DataFrame:
    return staging.incomes(raw.customer_income).select(
        KEY, "total_income", "avg_monthly_income",
        bands.income_group(F.col("avg_monthly_income")).alias("income_group"),
    )


def _casts(raw: RawTables) -> DataFrame:
    returned = F.col("return_date")
    return raw.customer_sales.select(
        "sale_id", F.col("sale_date").cast("date").alias("sale_date"),
        returned.cast("string").alias("return_date_text"), cleaning.cell_to_date(returned).alias("return_date"),
    )


def _markup(raw: RawTables) -> DataFrame:
    loan, cash = F.col("loan_price"), F.col("cash_price")
    return staging.customers(raw.customer_sales).select(
        "sale_id", money.financing_markup(loan, cash).alias("financing_markup"),
        money.markup_percentage(loan, cash).alias("markup_percentage"),
    )


def _share_by_gender(raw: RawTables) -> DataFrame:
    return segments.by_gender(raw).select(
        "gender", "total_loans", percent_of_total(F.col("total_loans")).alias("pct_of_portfolio")
    )


ON_RAW: dict[str, Callable[[RawTables], DataFrame]] = {
    # staging
    "stg_credit_snapshots": _facts,
    "stg_customers": lambda raw: staging.customers(raw.customer_sales),
    "stg_customer_demographics": staging.demographics,
    "stg_nps": lambda raw: staging.survey(raw.nps_data),
    # row-level joins, top-1, filters
    "join_full_outer": _full_outer,
    "join_left_customer_demo": enrich.customers_with_demographics,
    "int_customer_enriched": enrich.customer_enriched,
    "int_credit_with_customer": enrich.credit_with_customer,
    "int_credit_with_nps": enrich.credit_with_nps,
    "win_latest_nps": lambda raw: enrich.latest_responses(staging.survey(raw.nps_data)),
    "win_latest_snapshot": lambda raw: marts.latest_facts(_facts(raw)),
    "distinct_snapshots": lambda raw: enrich.snapshot_dates(_facts(raw)),
    "flt_latest_snapshot": lambda raw: staging.at_latest_snapshot(_facts(raw)).select(
        KEY, "snapshot_date", "balance", "days_past_due"
    ),
    "flt_valid_ids": _valid_ids,
    "flt_not_null": lambda raw: staging.survey(raw.nps_data).where(F.col("nps_score").isNotNull()).select(
        KEY, "submission_id", "nps_score"
    ),
    # scalar rules over whole tables
    "cln_sentinel_dates": lambda raw: _facts(raw).select(
        KEY, "snapshot_date", "return_date", "credit_expiry", "max_payment_date"
    ),
    "fn_parse_date": lambda raw: _facts(raw).select(KEY, "snapshot_date", "sale_date", "next_invoice_date"),
    "fn_casts": _casts,
    "fn_datediff_year": _on_facts(years=_tenure(calendar.years_between)),
    "fn_datediff_month": _on_facts(months=_tenure(calendar.months_between)),
    "fn_datediff_quarter": _on_facts(quarters=_tenure(calendar.quarters_between)),
    "fn_datediff_day": _on_facts(days=_tenure(calendar.days_between)),
    "fn_trunc_quarter": _on_facts(
        sale_quarter=lambda: calendar.quarter_start(F.col("sale_date")),
        snapshot_quarter=lambda: calendar.quarter_start(F.col("snapshot_date")),
    ),
    "fn_tenure": _on_facts(
        account_tenure_days=_tenure(calendar.days_between),
        account_tenure_months=_tenure(calendar.months_between),
    ),
    "fn_markup": _markup,
    "fn_income": lambda raw: staging.incomes(raw.customer_income).select(
        KEY, "total_income", "avg_monthly_income"
    ),
    "cohort_assign": lambda raw: marts.with_cohorts(_facts(raw)).select(
        KEY, "snapshot_date", "cohort_quarter", "cohort_age_quarters"
    ),
    "std_gender": lambda raw: staging.genders(raw.customer_gender).select(KEY, "gender"),
    "std_citizenship": lambda raw: staging.genders(raw.customer_gender).select(KEY, "citizenship"),
    "band_age_group": _age_bands,
    "band_income_group": _income_bands,
    "band_dpd": _dpd,
    "band_nps_category": lambda raw: raw.nps_data.select(
        F.col("`Submission ID`").alias("submission_id"), "nps_score",
        bands.nps_category(F.col("nps_score")).alias("nps_category"),
    ),
    "band_payment_performance": _on_facts(payment_performance=lambda: bands.payment_performance(
        F.col("balance_due_status"), F.col("arrears"), F.col("days_past_due")
    )),
    # marts and parts of them
    "mart_portfolio_performance": marts.portfolio_performance,
    "mart_cohort_analysis": marts.cohort_analysis,
    "mart_credit_vs_nps": marts.credit_vs_nps,
    "agg_balances": _parts(
        marts.portfolio_performance, "snapshot_date", "total_loans", "total_balance", "total_payments",
        "total_arrears", "avg_days_past_due",
    ),
    "agg_status_balances": _parts(
        marts.portfolio_performance, "snapshot_date", "up_to_date_balance", "arrears_balance",
        "total_arrears_amount",
    ),
    "agg_product_mix": _parts(
        marts.portfolio_performance, "snapshot_date", "galaxy_s_loans", "galaxy_a_loans", "note_loans",
        "iphone_loans", "term_12m_loans", "term_18m_loans", "term_24m_loans", "returned_devices",
    ),
    "agg_rates": _parts(
        marts.portfolio_performance, "snapshot_date", "arrears_rate_pct", "fpd_rate_pct", "paid_off_rate_pct",
        "arrears_balance_pct", "payment_collection_pct",
    ),
    "agg_repayment_rate": _parts(
        marts.cohort_analysis, "cohort_quarter", "cohort_age_quarters", "snapshot_date",
        "avg_repayment_rate_pct",
    ),
    "nps_summary_by_category": marts.nps_summary_by_category,
    "nps_summary_by_payment": marts.nps_summary_by_payment,
    # segments
    "seg_age_group": segments.by_age,
    "seg_income_group": segments.by_income,
    "seg_gender": segments.by_gender,
    "win_pct_of_total": _share_by_gender,
    "kpi_segment_extremes": segments.extremes,
    "kpi_gender_split": segments.gender_split,
    # reports
    "rpt_portfolio_trend": reports.portfolio_trend,
    "rpt_dpd_distribution": reports.dpd_distribution,
    "kpi_growth": reports.growth,
    "kpi_write_off_rate": reports.write_off_rate,
    "kpi_latest": reports.latest_kpis,
    "kpi_response_rate": reports.response_rate,
    "nps_by_payment_performance": reports.nps_by_payment_performance,
    "nps_by_category": reports.nps_by_category,
    "nps_distribution": reports.nps_distribution,
    "summary_metrics": reports.summary_metrics,
    # quality
    "dq_not_null": quality.not_null,
    "dq_unique": quality.unique,
    "dq_accepted_values": quality.accepted_values,
    "dq_staging_counts": quality.staging_counts,
    "dq_demographic_coverage": quality.demographic_coverage,
    "dq_band_coverage": segments.band_coverage,
    "dq_age_distribution": segments.age_distribution,
    "agg_union_stats": quality.union_stats,
    "agg_snapshot_breakdown": quality.snapshot_breakdown,
}


def _raw_folder(spark: SparkSession, sf_dir: str, *writers: Callable[[RawTables, str], None]) -> str:
    folder, raw = scratch_dir(spark), raw_tables(spark, sf_dir)
    for write in writers:
        write(raw, folder)
    return folder


def _scan(spark: SparkSession, folder: str, with_table: bool = False) -> DataFrame:
    return files.credit_scan(spark, files.entry_paths(files.discover(spark, folder)), with_table)


def _discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, sample_files.write_snapshots)
    sizes = _scan(spark, folder, True).groupBy("snapshot_table").agg(F.count(F.lit(1)).alias("row_count"))
    return files.discover(spark, folder).join(sizes, "snapshot_table").select("stem", "snapshot_table", "row_count")


def _snapshot_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, sample_files.write_snapshots)
    return _scan(spark, folder, True).select("loan_id", "date", "snapshot_table")


def _credit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, _raw_folder(spark, sf_dir, sample_files.write_snapshots))


def _sheet_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheets = files.sheet_tables(spark, _raw_folder(spark, sf_dir, sample_files.write_sheets))
    totals = {
        "customer_sales": ("Loan Id", F.sum("loan_price")),
        "customer_gender": ("Loan Id", F.count("gender").cast("double")),
        "customer_dob": ("Loan Id ", F.sum(F.year("date_of_birth")).cast("double")),
        "customer_income": ("Loan Id", F.sum("received")),
    }
    counted = [
        sheets[table].agg(
            F.count(F.lit(1)).alias("row_count"), F.count(f"`{key}`").alias("loan_ids"), total.alias("total")
        ).select(F.lit(table).alias("table_name"), "row_count", "loan_ids", "total")
        for table, (key, total) in totals.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def _missing_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sales sheet whose empty return dates are written as 'NaT'."""
    folder, sales = scratch_dir(spark), raw_tables(spark, sf_dir).customer_sales
    written = sales.withColumn("return_date", F.coalesce(F.col("return_date").cast("string"), F.lit(cleaning.MISSING_CELL_DATE)))
    written.write.options(**files.CSV_OPTIONS).csv(f"{folder}/{files.WORKBOOK}/Sales Details.csv")
    return staging.customers(files.sheet(spark, folder, "Sales Details")).select(KEY, "sale_id", "sale_date", "return_date")


def _survey_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _raw_folder(spark, sf_dir, sample_files.write_survey)
    return files.survey(spark, folder, sample_files.SAMPLE_HEADERS)


def _optional_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder with snapshots only: the other tables come out empty."""
    raw = files.load_raw(spark, _raw_folder(spark, sf_dir, sample_files.write_snapshots))
    counted = [
        getattr(raw, table).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), "row_count"
        )
        for table in schemas.RAW_TABLES
    ]
    return reduce(DataFrame.unionAll, counted)


def _ingested(spark: SparkSession, sf_dir: str, after: Callable[[str], object] = lambda target: None) -> tuple[str, DataFrame]:
    """Three snapshots, one of them in part; then its late part files, the other two and a second file for the first.

    Returns the folder of the ingested tables and the ledger; ``after`` is called after each ingest.
    """
    folder, target = scratch_dir(spark), scratch_dir(spark)
    snapshots = list(sample_files.snapshot_rows(raw_tables(spark, sf_dir)).items())
    early = F.crc32("loan_id") % 2 == 0
    for n, (table, df) in enumerate(snapshots[:3]):
        sample_files.write_snapshot(df.where(early) if n == 1 else df, folder, table)
    ingest.ingest(spark, folder, target)
    after(target)
    sample_files.write_snapshot(snapshots[1][1].where(~early), folder, snapshots[1][0], mode="append")
    for table, df in snapshots[3:]:
        sample_files.write_snapshot(df, folder, table)
    sample_files.write_snapshot(snapshots[0][1], folder, snapshots[0][0], suffix=" (copy)")
    ledger = ingest.ingest(spark, folder, target)
    after(target)
    return target, ledger


def _from_states(name: str) -> Query:
    """A mart from the states of two ingests, the second with late rows of a snapshot of the first."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, _ = _ingested(spark, sf_dir, lambda target: states.update(spark, target))
        return states.mart(spark, target, name, raw_tables(spark, sf_dir))

    return query


def _newest_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest facts of two ingests, the second with late rows of a snapshot of the first."""
    target, _ = _ingested(spark, sf_dir, lambda target: states.update_newest(spark, target))
    return states.newest_facts(spark, target)


def _scored_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.credit_vs_nps(raw_tables(spark, sf_dir), _newest_from_state(spark, sf_dir))


def _responses_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest responses after three batches that overlap in time, one of them merged twice."""
    path = f"{scratch_dir(spark)}/newest_responses"
    rows = enrich.response_rows(staging.survey(raw_tables(spark, sf_dir).nps_data))
    part = F.crc32(F.col("submission_id").cast("string")) % 3
    for n in (2, 0, 2, 1):
        newest = states.merge_newest(rows.where(part == n), path, KEY, enrich.response_order())
    return newest.drop("submission_id")


def _observed(check: str) -> Query:
    """Check results that were counted while the facts, in two ingests, and the other models were stored."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target, _ = _ingested(spark, sf_dir)
        rows, staged = ingest.check_results(spark, target), quality.staged(raw_tables(spark, sf_dir))
        for name in pipeline.MODELS:
            rows += quality.store(staged[name], name, f"{target}/models/{name}")[1]
        return quality.results(spark, rows, check)

    return query


def _mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots whose part files have their columns in two orders, one with a column of its own."""
    folder, early = scratch_dir(spark), F.crc32("loan_id") % 2 == 0
    for table, df in sample_files.snapshot_rows(raw_tables(spark, sf_dir)).items():
        sample_files.write_snapshot(df.where(early), folder, table)
        turned = df.where(~early).select(*reversed(df.columns), F.lit("x").alias("remark"))
        sample_files.write_snapshot(turned, folder, table, mode="append")
    return _scan(spark, folder)


def _replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by one that reads its rows, and after that a replacement that fails half way."""
    mart, path = marts.cohort_analysis(raw_tables(spark, sf_dir)), f"{scratch_dir(spark)}/mart"
    tables.replace_table(mart.where("cohort_age_quarters = 0"), path)
    young = tables.current_table(spark, path)
    tables.replace_table(young.unionAll(mart.where("cohort_age_quarters <> 0")), path)
    fails = F.when(F.col("cohort_age_quarters") > 0, F.raise_error(F.lit("fails half way")).cast("bigint"))
    try:
        tables.replace_table(mart.withColumn("cohort_size", F.coalesce(fails, "cohort_size")), path)
    except PySparkException:
        return tables.current_table(spark, path)
    raise AssertionError("the replacement should have failed")


def _load_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, ledger = _ingested(spark, sf_dir)
    loaded = ingest.facts(spark, target).groupBy("snapshot_table").agg(F.count(F.lit(1)).alias("row_count"))
    entries = lambda action: F.count_distinct(F.when(F.col("action") == action, F.col("entry")))
    files_seen = ledger.groupBy("snapshot_table").agg(
        entries("loaded").alias("files_loaded"), entries("skipped").alias("files_skipped"),
    )
    return files_seen.join(loaded, "snapshot_table")


def _latest_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _ = _ingested(spark, sf_dir)
    return ingest.latest_facts(spark, target).select(KEY, "snapshot_date", "balance", "days_past_due")


def _row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = set(sample_files.register_tables(spark, raw_tables(spark, sf_dir)))
    return catalog.row_counts(spark, [name for name in catalog.table_names(spark) if name in known])


def _snapshot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample_files.register_tables(spark, raw_tables(spark, sf_dir))
    named = [
        spark.table(name).agg(F.max("date").alias("date")).select(F.lit(name).alias("table_name"), "date")
        for name in catalog.snapshot_tables(spark)
    ]
    return reduce(DataFrame.unionAll, named)


def _snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample_files.register_tables(spark, raw_tables(spark, sf_dir))
    names = catalog.snapshot_tables(spark)
    return catalog.row_counts(spark, names).withColumn("tables_detected", F.lit(len(names)).cast("bigint"))


def _union_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample_files.register_tables(spark, raw_tables(spark, sf_dir))
    return staging.credit_snapshots(catalog.union_snapshots(spark))


def _mart_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.cohort_analysis(raw_tables(spark, sf_dir))
    return tables.save_parquet(mart, f"{scratch_dir(spark)}/mart_cohort_analysis")


def _named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline twice with a database; the second time the raw sheets and the survey have gone."""
    folder, out, raw = scratch_dir(spark), scratch_dir(spark), raw_tables(spark, sf_dir)
    for write in (sample_files.write_snapshots, sample_files.write_sheets, sample_files.write_survey):
        write(raw, folder)
    database = f"loanscope_{out.rsplit('/', 1)[1]}"
    spark.sql(f"create database {database} location '{out}/database'")
    names = [*(name for name in schemas.RAW_TABLES if name != "credit_data"), "mart_cohort_analysis"]

    def run() -> dict[str, list[str]]:
        """The files of each named table after a run."""
        pipeline.run(spark, folder, out, sample_files.SAMPLE_HEADERS, database)
        return {name: sorted(spark.table(f"{database}.{name}").inputFiles()) for name in names}

    before = run()
    sample_files.remove_sheets_and_survey(spark, folder)
    after = run()
    counted = [
        spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(before[name] == after[name]).alias("kept"),
        )
        for name in names
    ]
    return reduce(DataFrame.unionAll, counted)


def _csv_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort export read back, with the place of each row in the written order."""
    out, mart = scratch_dir(spark), marts.cohort_analysis(raw_tables(spark, sf_dir))
    export.export_all(spark, raw_tables(spark, sf_dir), out, [e for e in export.EXPORTS if e.name == "mart_cohort_analysis"])
    rows = spark.read.options(**files.CSV_OPTIONS).schema(mart.schema).csv(f"{out}/mart_cohort_analysis.csv")
    order = Window.orderBy(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return rows.select("*", F.row_number().over(order).cast("bigint").alias("position"))


def _export_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good exports between one that fails in Python and one whose target lies below a file."""
    out, by_name = scratch_dir(spark), {e.name: e for e in export.EXPORTS}
    def fails(raw: RawTables) -> DataFrame:
        raise ValueError("no such report")

    blocked = export.Export("below_a_file/x", by_name["SUMMARY"].build)
    spark.range(1).selectExpr("'x' as value").coalesce(1).write.text(f"{out}/blocker")
    part = spark.read.text(f"{out}/blocker").inputFiles()[0]
    status = export.export_all(
        spark, raw_tables(spark, sf_dir), out,
        [export.Export("fails_in_python", fails), by_name["mart_portfolio_performance"], blocked, by_name["stg_customers"]],
        places={"below_a_file/x": f"{part}/x.csv"},
    )
    return status.select("export", "status", "rows", F.col("error").isNotNull().alias("has_reason"))


def _csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = export.export_all(spark, raw_tables(spark, sf_dir), scratch_dir(spark))
    return status.select("export", "status", "rows")


ON_FILES: dict[str, Query] = {
    "src_discover_files": _discover_files,
    "src_snapshot_name": _snapshot_name,
    "src_credit_scan": _credit_scan,
    "src_sheet_tables": _sheet_tables,
    "src_survey": _survey_file,
    "src_optional": _optional_sources,
    "src_load_once": _load_once,
    "src_latest_ingested": _latest_ingested,
    "src_missing_cells": _missing_cells,
    "cat_row_counts": _row_counts,
    "cat_snapshot_tables": _snapshot_tables,
    "cat_snapshot_counts": _snapshot_counts,
    "cat_union_snapshots": _union_of_tables,
    "sink_mart_table": _mart_table,
    "sink_replaced_table": _replaced_table,
    "mart_portfolio_from_states": _from_states("mart_portfolio_performance"),
    "mart_cohort_from_states": _from_states("mart_cohort_analysis"),
    "win_latest_snapshot_from_state": _newest_from_state,
    "win_latest_nps_from_state": _responses_from_state,
    "mart_credit_vs_nps_from_state": _scored_from_state,
    "dq_observed_not_null": _observed("not_null"),
    "dq_observed_accepted_values": _observed("accepted_values"),
    "src_mixed_headers": _mixed_headers,
    "sink_csv_export": _csv_export,
    "sink_csv_content": _csv_content,
    "sink_export_isolation": _export_isolation,
    "sink_named_tables": _named_tables,
}


def _over_tables(build: Callable[[RawTables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(raw_tables(configure(spark), sf_dir))


def _over_files(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {**{name: _over_tables(build) for name, build in ON_RAW.items()},
            **{name: _over_files(query) for name, query in ON_FILES.items()}}
