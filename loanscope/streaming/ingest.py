"""Load every snapshot file once, without naming the files.

A file-source stream over the file names (contents are not read by it) with a
checkpoint hands each new file to one micro-batch; ``availableNow`` makes it a
job that ends. The first entry (file, or folder of part files) of a snapshot
table owns the table: part files that arrive in it later are added, files of any
other entry for the table are skipped. A batch scans its files, writes the
conformed rows by snapshot date, table and batch, then the results of the column
checks, which are counted in the same pass, and then its ledger rows, one per
file. All writes replace what an earlier attempt of the same batch left
behind, so a batch that is run again neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from loanscope.plans import quality, staging
from loanscope.sources import files, schemas

FACTS, LEDGER, CHECKPOINT, CHECKS = "credit_data", "ingest_ledger", "ingest_checkpoint", "ingest_checks"
MODEL = "stg_credit_snapshots"
LEDGER_SCHEMA = "path string, entry string, stem string, snapshot_table string, action string, batch_id bigint"
CHECKS_SCHEMA = f"{quality.RESULTS}, batch_id bigint"
# Partition columns of the facts, besides the conformed ones.
SNAPSHOT_DATE, SNAPSHOT_TABLE, BATCH = "snapshot_date", "snapshot_table", "ingest_batch"
# Columns of the file listing source.
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ledger(spark: SparkSession, table_dir: str) -> DataFrame:
    """What was done with every file seen so far: 'loaded' or 'skipped'."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(f"{table_dir}/{LEDGER}")
    except AnalysisException as error:
        if not files.is_missing(error):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def facts(spark: SparkSession, table_dir: str) -> DataFrame:
    """Conformed facts ingested so far, with the snapshot table each row came from; empty before the first."""
    raw = spark.createDataFrame([], T.StructType([*schemas.CREDIT.fields, T.StructField(SNAPSHOT_TABLE, T.StringType())]))
    conformed = staging.credit_snapshots(raw, SNAPSHOT_TABLE)
    columns = [*(c for c in conformed.columns if c != SNAPSHOT_TABLE), SNAPSHOT_TABLE]
    try:
        stored = spark.read.schema(conformed.schema).parquet(f"{table_dir}/{FACTS}")
    except AnalysisException as error:
        if not files.is_missing(error):
            raise
        return conformed.select(columns)
    return stored.select(columns)


def batch_facts(spark: SparkSession, table_dir: str, batches: list[int]) -> DataFrame:
    """Conformed facts of some batches, with the number of each; partitions of other batches are not read."""
    conformed = staging.credit_snapshots(spark.createDataFrame([], schemas.CREDIT)).withColumn(BATCH, F.lit(0).cast("bigint"))
    if not batches:
        return conformed
    stored = spark.read.schema(conformed.schema).parquet(f"{table_dir}/{FACTS}")
    return stored.where(F.col(BATCH).isin(batches)).select(conformed.columns)


def batches_without(spark: SparkSession, table_dir: str, done: DataFrame) -> list[int]:
    """Numbers of the loaded batches that ``done`` (batch_id) does not hold."""
    loaded = ledger(spark, table_dir).where("action = 'loaded'").select(F.col("batch_id").cast("bigint")).distinct()
    return sorted(r.batch_id for r in loaded.join(done.select("batch_id").distinct(), "batch_id", "left_anti").collect())


def _write_checks(spark: SparkSession, table_dir: str, rows: list[tuple], batch_id: int) -> None:
    counted = spark.createDataFrame([(*row, batch_id) for row in rows], CHECKS_SCHEMA)
    counted.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "batch_id"
    ).parquet(f"{table_dir}/{CHECKS}")


def check_results(spark: SparkSession, table_dir: str) -> list[tuple[str, str, str, int]]:
    """Results of the column checks over all ingested facts, summed over batches.

    No facts are read for it but those of batches that were loaded without being counted, once.
    """
    def stored() -> DataFrame:
        try:
            return spark.read.schema(CHECKS_SCHEMA).parquet(f"{table_dir}/{CHECKS}")
        except AnalysisException as error:
            if not files.is_missing(error):
                raise
            return spark.createDataFrame([], CHECKS_SCHEMA)

    for batch_id in batches_without(spark, table_dir, stored()):
        watch = quality.Watch(MODEL)
        watch.over(batch_facts(spark, table_dir, [batch_id])).write.format("noop").mode("overwrite").save()
        _write_checks(spark, table_dir, watch.rows(), batch_id)
    sums = stored().groupBy("check", "model", "column_name").agg(F.sum("failing_rows").alias("n"))
    counted = {row[:3]: row[3] for row in map(tuple, sums.collect())}
    return [(check, MODEL, column, counted.get((check, MODEL, column), 0)) for check, column in quality.Watch(MODEL).checks()]


def latest_facts(spark: SparkSession, table_dir: str) -> DataFrame:
    """The facts of the newest snapshot date: it comes from partition values, and only its partitions are read."""
    return staging.at_latest_snapshot(facts(spark, table_dir))


def _decide(found: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of the entry that owns their table are loaded: the one it was loaded from before, or else the first by name."""
    firsts = found.groupBy("snapshot_table").agg(F.min("entry").alias("first"))
    known = loaded.where(F.col("action") == "loaded").groupBy("snapshot_table").agg(F.min("entry").alias("known"))
    judged = found.join(firsts, "snapshot_table").join(known, "snapshot_table", "left")
    load = F.col("entry") == F.coalesce("known", "first")
    return judged.select(
        "path", "entry", "stem", "snapshot_table", F.when(load, "loaded").otherwise("skipped").alias("action")
    )


def ingest(spark: SparkSession, raw_dir: str, table_dir: str) -> DataFrame:
    """Load the files that are new since the last call; returns the ledger."""

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        earlier = ledger(session, table_dir).where(F.col("batch_id") < batch_id)
        decided = _decide(files.entry_files(batch), earlier)
        # File names only: a scan needs them on the driver.
        rows = [tuple(row) for row in decided.collect()]
        if paths := sorted(path for path, *_, action in rows if action == "loaded"):
            scanned = files.credit_scan(session, paths, with_table=True)
            watch = quality.Watch(MODEL)
            conformed = watch.over(staging.credit_snapshots(scanned, SNAPSHOT_TABLE)).withColumn(BATCH, F.lit(batch_id))
            conformed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                SNAPSHOT_DATE, SNAPSHOT_TABLE, BATCH
            ).parquet(f"{table_dir}/{FACTS}")
            _write_checks(session, table_dir, watch.rows(), batch_id)
        entries = session.createDataFrame([(*row, batch_id) for row in rows], LEDGER_SCHEMA)
        entries.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "batch_id"
        ).parquet(f"{table_dir}/{LEDGER}")

    listing = spark.readStream.format("binaryFile").schema(LISTING_SCHEMA).load(f"{raw_dir}/{files.CREDIT_FILES}")
    query = (
        listing.select("path")
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", f"{table_dir}/{CHECKPOINT}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return ledger(spark, table_dir)
