"""Raw folder in, stored marts, CSV exports and check results out."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from loanscope.plans import marts, quality, states
from loanscope.sinks import export, tables
from loanscope.sources import files, schemas
from loanscope.sources.derived import RawTables
from loanscope.streaming import ingest

#: Marts built from the newest facts; those of ``states.KINDS`` come from stored states of each batch.
MARTS = {"mart_credit_vs_nps": marts.credit_vs_nps}
#: Models that are stored besides the facts, with their checks counted on the way.
MODELS = ("stg_customers", "stg_nps")


def stored_inputs(
    spark: SparkSession, raw_dir: str, out_dir: str, facts: DataFrame, survey_headers: dict[str, str] | None = None,
    database: str | None = None,
) -> RawTables:
    """The facts, and the sheets and the survey as tables that are loaded once, by name if there is a database.

    A source that is absent is not stored, so it is loaded when it comes; a stored table stays when its source goes.
    """
    raw = files.load_raw(spark, raw_dir, survey_headers, credit_data=facts)
    found = files.present(spark, raw_dir)

    def table(name: str) -> DataFrame:
        path, title = f"{out_dir}/raw/{name}", f"{database}.{name}" if database else None
        if name not in found and tables.stored_table(spark, path) is None:
            return getattr(raw, name)
        return tables.store_once(spark, lambda: getattr(raw, name), path, title)

    names = [name for name in schemas.RAW_TABLES if name != "credit_data"]
    return RawTables(credit_data=lambda: facts, **{name: partial(table, name) for name in names})


def run(
    spark: SparkSession, raw_dir: str, out_dir: str, survey_headers: dict[str, str] | None = None,
    database: str | None = None,
) -> dict[str, DataFrame]:
    """Ingest new snapshots, bring models and marts up to date, each replaced as one act, export them, report the checks."""
    seen = ingest.ingest(spark, raw_dir, f"{out_dir}/ingested")
    states.update(spark, f"{out_dir}/ingested")
    states.update_newest(spark, f"{out_dir}/ingested")
    facts = ingest.facts(spark, f"{out_dir}/ingested").drop("snapshot_table")
    raw = stored_inputs(spark, raw_dir, out_dir, facts, survey_headers, database)
    stored, checked = {}, ingest.check_results(spark, f"{out_dir}/ingested")
    staged = quality.staged(raw)
    for name in MODELS:
        stored[name], rows = quality.store(staged[name], name, f"{out_dir}/models/{name}")
        checked += rows
    models = dict(stored)
    newest = states.newest_facts(spark, f"{out_dir}/ingested")
    built = {name: states.mart(spark, f"{out_dir}/ingested", name, raw) for name in states.KINDS}
    for name, mart in {**built, **{name: build(raw, newest) for name, build in MARTS.items()}}.items():
        stored[name] = tables.replace_table(mart, f"{out_dir}/marts/{name}")
        if database:
            tables.name_table(spark, f"{database}.{name}", tables.version_path(spark, f"{out_dir}/marts/{name}"))
    exports = [
        replace(item, build=lambda _, table=stored[item.name]: table) if item.name in stored else item
        for item in export.EXPORTS
    ]
    return {
        "ledger": seen,
        **stored,
        "exports": export.export_all(spark, raw, f"{out_dir}/processed", exports),
        "not_null": quality.results(spark, checked, "not_null"),
        "unique": quality.unique(raw, stored=models),
        "accepted_values": quality.results(spark, checked, "accepted_values"),
    }
