"""Small raw tables for tests; unnamed columns get a default."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanscope.sources import schemas
from loanscope.sources.derived import RawTables

CREDIT_DEFAULTS = {
    "date": "1/1/2025", "sale_date": "11/20/2024", "next_invoice_date": "1/8/2025", "return_date": "None",
    "credit_expiry": "None", "max_payment_date": "12/28/2024", "balance_due_status": "Arrears",
    "account_status_l2": "Active",
}


def table(spark: SparkSession, name: str, rows: list[dict]) -> DataFrame:
    schema = schemas.RAW_TABLES[name]
    defaults = CREDIT_DEFAULTS if name == "credit_data" else {}
    values = [tuple({**defaults, **row}.get(column) for column in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(values, schema)


def raw_tables(spark: SparkSession, **rows: list[dict]) -> RawTables:
    return RawTables(**{
        name: (lambda name=name: table(spark, name, rows.get(name, []))) for name in schemas.RAW_TABLES
    })
