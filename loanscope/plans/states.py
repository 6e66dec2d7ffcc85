"""Marts and newest rows from stored per-loan states, so that a new snapshot costs its own rows and not all facts.

A state is what the marts need of the facts of one (cohort, snapshot, loan): sums, counts
and flag bits. Each ingested batch adds its states once, below partitions of its
snapshot dates and its number; facts of other batches are not read. Sums add up
and bits are OR-ed, so states of several batches merge, late part files of an
old snapshot included. A batch whose states are written again replaces its own.

The newest fact of each loan is one table, into which new batches are merged: the
better of the stored row and the batch's stays, in whatever order batches come.
Merging a batch twice changes nothing, so an update that was lost half way is
done again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loanscope.operators.latest import latest_per_key
from loanscope.plans import marts
from loanscope.plans.loan_grain import FACT_FLAGS
from loanscope.plans.staging import KEY
from loanscope.sinks import tables
from loanscope.sources import files
from loanscope.sources.derived import RawTables
from loanscope.streaming import ingest

# Not the names of before, when each mart had states of its own: batches done then get these.
STATES, DONE = "cohort_loan_states", "cohort_loan_states_done"
NEWEST, NEWEST_DONE = "newest_facts", "newest_facts_done"
#: Mart: which states it takes, its keys besides the loan, and what makes it of them.
KINDS = {
    "mart_portfolio_performance": ("true", ["snapshot_date"], marts.portfolio_of),
    "mart_cohort_analysis": ("cohort_quarter is not null", list(marts.COHORT_KEYS), marts.cohort_of),
}


def _done(spark: SparkSession, table_dir: str, done: str) -> DataFrame:
    try:
        return spark.read.schema("batch_id bigint").parquet(f"{table_dir}/{done}")
    except AnalysisException as error:
        if not files.is_missing(error):
            raise
        return spark.createDataFrame([], "batch_id bigint")


def _new(spark: SparkSession, table_dir: str, done: str) -> list[int]:
    """Loaded batches that are not done yet: a number per batch, not per row."""
    return ingest.batches_without(spark, table_dir, _done(spark, table_dir, done))


def _mark(spark: SparkSession, table_dir: str, done: str, batches: list[int]) -> None:
    spark.createDataFrame([(n,) for n in batches], "batch_id bigint").coalesce(1).write.mode("append").parquet(f"{table_dir}/{done}")


def merge_newest(batch: DataFrame, path: str, key: str, order: list[Column]) -> DataFrame:
    """Merge a batch into the table of the first row of every key, and replace it as one act.

    One row per key and task of the batch is shuffled, and the stored rows, whatever history has gone into them.
    """
    rows = batch
    if tables.current_version(batch.sparkSession, path) is not None:
        rows = tables.current_table(batch.sparkSession, path).unionByName(batch)
    return tables.replace_table(latest_per_key(rows, key, *order), path)


def update_newest(spark: SparkSession, table_dir: str) -> list[int]:
    """Merge the facts of batches that are not in the newest facts yet; returns their numbers."""
    new = _new(spark, table_dir, NEWEST_DONE)
    if new:
        batch = ingest.batch_facts(spark, table_dir, new).select(KEY, *marts.FACT_COLUMNS)
        merge_newest(batch, f"{table_dir}/{NEWEST}", KEY, marts.fact_order())
        _mark(spark, table_dir, NEWEST_DONE, new)
    return new


def newest_facts(spark: SparkSession, table_dir: str) -> DataFrame:
    """The newest snapshot row of each loan over all merged batches; empty before the first."""
    if tables.current_version(spark, f"{table_dir}/{NEWEST}") is None:
        return ingest.batch_facts(spark, table_dir, []).select(KEY, *marts.FACT_COLUMNS)
    return tables.current_table(spark, f"{table_dir}/{NEWEST}")


def update(spark: SparkSession, table_dir: str) -> list[int]:
    """Store the states of batches that have none yet; returns their numbers."""
    new = _new(spark, table_dir, DONE)
    if new:
        states = marts.loan_states(ingest.batch_facts(spark, table_dir, new), ingest.BATCH)
        states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            ingest.SNAPSHOT_DATE, ingest.BATCH
        ).parquet(f"{table_dir}/{STATES}")
        # last, so that a batch counts as done only with all its states
        _mark(spark, table_dir, DONE, new)
    return new


def _merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state per (keys, loan).

    States are dealt by loan, for the merge and the join with the customer side alike: a loan has no more of
    them than batches, snapshots and sale quarters, whatever the number of its facts.
    """
    taken = {*marts.COHORT_KEYS, KEY, "is_loan", ingest.BATCH, FACT_FLAGS.column}
    sums = (F.sum(name).alias(name) for name in states.columns if name not in taken)
    merged = states.repartition(KEY).groupBy(*keys, KEY).agg(*sums, FACT_FLAGS.merge())
    return merged.withColumn("is_loan", F.col(KEY).isNotNull().cast("bigint"))


def mart(spark: SparkSession, table_dir: str, name: str, raw: RawTables) -> DataFrame:
    """The mart over all batches that have states; the customer side of ``raw`` is read, its facts are not."""
    taken, keys, finish = KINDS[name]
    empty = marts.loan_states(ingest.batch_facts(spark, table_dir, []), ingest.BATCH)
    try:
        states = spark.read.schema(empty.schema).parquet(f"{table_dir}/{STATES}")
    except AnalysisException as error:
        if not files.is_missing(error):
            raise
        states = empty
    return finish(_merged(states.where(taken), keys), raw)
