"""The derived inputs laid out as raw files and as catalog tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from loanscope.sources import files, schemas
from loanscope.sources.derived import SNAPSHOTS, RawTables

# The survey export is headed by question texts naming some brand and its app.
SAMPLE_HEADERS = schemas.survey_headers(brand="Acme", app="AcmeApp")
# A compressed file is read by one task, so a part file has no more rows than this.
PART_ROWS = 200_000
CSV_PARTS = {**files.CSV_OPTIONS, "compression": "snappy", "maxRecordsPerFile": PART_ROWS}


def _us_date(day: str) -> str:
    date = dt.date.fromisoformat(day)
    return f"{date.month}/{date.day}/{date.year}"


def snapshot_rows(raw: RawTables) -> dict[str, DataFrame]:
    """Physical snapshot table name → its rows."""
    return {table: raw.credit_data.where(F.col("date") == _us_date(day)) for _, day, table in SNAPSHOTS}


def write_snapshot(df: DataFrame, raw_dir: str, table: str, suffix: str = "", mode: str = "errorifexists") -> None:
    stamp = table.removeprefix(files.TABLE_PREFIX)
    name = f"Credit Data - {stamp[6:]}-{stamp[4:6]}-{stamp[:4]}{suffix}"
    df.write.mode(mode).options(**CSV_PARTS).csv(f"{raw_dir}/{name}.csv")


def write_snapshots(raw: RawTables, raw_dir: str) -> None:
    for table, df in snapshot_rows(raw).items():
        write_snapshot(df, raw_dir, table)


def write_sheets(raw: RawTables, raw_dir: str) -> None:
    """Two sheets as CSV, two as Parquet."""
    for sheet, (table, _) in schemas.SHEETS.items():
        df, base = getattr(raw, table), f"{raw_dir}/{files.WORKBOOK}/{sheet}"
        if sheet in ("Gender", "DOB"):
            df.write.parquet(f"{base}.parquet")
        else:
            df.write.options(**CSV_PARTS).csv(f"{base}.csv")


def write_survey(raw: RawTables, raw_dir: str) -> None:
    questions = {column: text for text, column in SAMPLE_HEADERS.items()}
    # As text, to keep the microseconds.
    stamped = raw.nps_data.withColumn("Submitted at", F.col("Submitted at").cast("string"))
    renamed = stamped.withColumnsRenamed(questions)
    renamed.write.options(**CSV_PARTS).csv(f"{raw_dir}/{files.SURVEY_FILE}.csv")


def remove_sheets_and_survey(spark: SparkSession, raw_dir: str) -> None:
    """Delete what ``write_sheets`` and ``write_survey`` have written, in whatever store it lies."""
    for name in (files.WORKBOOK, f"{files.SURVEY_FILE}.csv"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{raw_dir}/{name}")
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            raise FileNotFoundError(f"nothing at {path}")


def register_tables(spark: SparkSession, raw: RawTables) -> list[str]:
    """Register one view per snapshot and per other raw table; returns their names."""
    others = {table: getattr(raw, table) for table in schemas.RAW_TABLES if table != "credit_data"}
    views = {**snapshot_rows(raw), **others}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
