"""Raw files: credit snapshots found by name, customer sheets, the survey.

A "file" may be one file or a folder of part files of that name, so large
snapshots are read in parallel. Workbook sheets are expected as one CSV or
Parquet file or folder per sheet, below a folder named after the workbook.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Iterable, Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from loanscope.functions.cleaning import MISSING_CELL_DATE, na_to_null, nan_to_null
from loanscope.sources import schemas
from loanscope.sources.derived import RawTables

log = logging.getLogger(__name__)

# Names the raw files go by.
CREDIT_FILES = "Credit Data - *.csv"
CREDIT_ENTRY = r"^(.*/(Credit Data - [^/]*)\.csv)(?:/[^/]*)?$"
FILE_DATE = r"([0-9]{2})-([0-9]{2})-([0-9]{4})"
WORKBOOK = "Sales and Customer Data"
SURVEY_FILE = "NPS Data"
TABLE_PREFIX = "credit_data_"

ENTRY_SCHEMA = "entry string, stem string, snapshot_table string"
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def _file_date(stem: Column) -> Column:
    """``dd-mm-yyyy`` in a name, or nothing."""
    return F.regexp_extract(stem, FILE_DATE, 0)


def snapshot_table(stem: Column, date: Column | None = None) -> Column:
    """``… dd-mm-yyyy …`` → ``credit_data_yyyymmdd``; an undated name is made an identifier."""
    date = _file_date(stem) if date is None else date
    year, month, day = F.substring(date, 7, 4), F.substring(date, 4, 2), F.substring(date, 1, 2)
    dated = F.concat(F.lit(TABLE_PREFIX), year, month, day)
    return F.when(date != "", dated).otherwise(F.translate(F.lower(stem), " -", "__"))


def entry_files(paths: DataFrame) -> DataFrame:
    """Listed ``path`` values → one row per file with its snapshot entry and the table it belongs to."""
    named = paths.select(
        "path",
        F.regexp_extract("path", CREDIT_ENTRY, 1).alias("entry"),
        F.regexp_extract("path", CREDIT_ENTRY, 2).alias("stem"),
    ).where(F.col("entry") != "")
    return named.withColumn("snapshot_table", snapshot_table(F.col("stem"))).distinct()


def entries(paths: DataFrame) -> DataFrame:
    """Listed ``path`` values → one row per snapshot file or folder with the table it belongs to."""
    return entry_files(paths).drop("path").distinct()


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def discover(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Snapshot files below the raw folder. Only names are listed, no content is read."""
    try:
        listed = spark.read.format("binaryFile").load(f"{raw_dir}/{CREDIT_FILES}")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return spark.createDataFrame([], ENTRY_SCHEMA)
    return entries(listed.select("path"))


def _typed(field: T.StructField) -> Column:
    text = na_to_null(F.col(f"`{field.name}`"))
    if isinstance(field.dataType, (T.LongType, T.IntegerType)):
        # Columns with gaps are often written as 3.0; a real fraction stays an error.
        text = F.regexp_replace(text, r"\.0+$", "")
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.nullif(text, F.lit(MISSING_CELL_DATE))
    return text.cast(field.dataType).alias(field.name)


def _first_lines(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that is not blank of a partition, which holds one file."""
    for batch in source:
        for path, line in zip(*(column.to_pylist() for column in batch.columns)):
            if line.strip():
                yield pa.record_batch([pa.array([path]), pa.array([next(csv.reader([line]))], pa.list_(pa.string()))], names=["path", "names"])
                return


#: A line with something in it, whatever counts as white space.
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
#: Bytes that a file counts at least when partitions are made up, so that none holds a second file or a part of one.
ONE_FILE = str(1 << 42)


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, names) of every CSV file at or below the paths, from one job; files without a line have no row.

    The session for it has settings of its own: a file is one partition. Its lines are numbered where they are
    read, and only the first leaves the scan: a Python task would be sent all others too, even if it has ended.
    """
    apart = spark.newSession()
    for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"):
        apart.conf.set(name, ONE_FILE)
    lines = apart.read.text(paths).where(F.col("value").rlike(NOT_BLANK))
    numbered = lines.select("value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("id"))
    first = numbered.where(F.col("id") % F.lit(1 << 33) == 0)  # the lower 33 bits count the rows of a partition
    return first.select(_decoded(F.col("file")).alias("path"), "value").mapInArrow(_first_lines, "path string, names array<string>")


def _safe_names(names: list[str]) -> tuple[str, ...]:
    """Names of a header as a scan without a schema gives them: numbered where empty or repeated."""
    lower = [name.lower() for name in names]
    return tuple(
        f"_c{k}" if not name else f"{name}{k}" if lower.count(name.lower()) > 1 else name for k, name in enumerate(names)
    )


def _by_header(spark: SparkSession, paths: list[str], multiline: bool) -> dict[tuple[str, ...], list[str]]:
    """Paths by the header of their files. A header over several lines is read by Spark's own reader, path by path."""
    found: dict[tuple[str, ...], list[str]] = {}
    if multiline:
        reader = spark.read.options(**CSV_OPTIONS, multiLine=True)
        for path in paths:
            found.setdefault(tuple(reader.csv(path).columns), []).append(path)
        return found
    # a row per file: a scan needs their names on the driver
    for row in headers(spark, paths).collect():
        found.setdefault(_safe_names(row.names), []).append(row.path)
    return {names: sorted(group) for names, group in sorted(found.items())}


def _csv_by_name(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType, extra: tuple[Column, ...] = (),
    renames: dict[str, str] | None = None, multiline: bool = False,
) -> DataFrame | None:
    """CSV files matched to the schema by column name, whatever their column order.

    One scan per distinct header, which may differ between the part files of a folder;
    Spark checks every file against the header of its scan. Files without a line hold no
    rows, and None stands for files that all have none. Columns outside the schema are not parsed.
    """
    reader = spark.read.options(**CSV_OPTIONS, enforceSchema=False, multiLine=multiline)
    scans, typed = [], [*map(_typed, schema.fields), *extra]
    for names, group in _by_header(spark, list(paths), multiline).items():
        texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
        scan = reader.schema(texts).csv(group).withColumnsRenamed(renames or {})
        scans.append(scan.select(*typed))
    return reduce(DataFrame.unionByName, scans) if scans else None


def _decoded(address: Column) -> Column:
    """A path as it is, not as an address."""
    return F.url_decode(F.replace(address, F.lit("+"), F.lit("%2B")))


def _entry_stem() -> Column:
    """The stem of the entry of a row's file: it is the last name of the path or the one before, so no more is searched.

    For the scan itself only. A metadata column would widen each scanned row by the path and copy the row for it.
    """
    end = F.substring_index(F.input_file_name(), "/", -2)
    return F.regexp_extract(F.concat(F.lit("/"), _decoded(end)), CREDIT_ENTRY, 2)


def credit_scan(spark: SparkSession, found: list[str], with_table: bool = False) -> DataFrame:
    """All rows of the given snapshot files and folders, typed; optionally with their table name.

    Stem and date of the name are found in projections of their own, hence once a row: each use of an expression
    within one is generated anew.
    """
    extra = (_entry_stem().alias("_stem"),) if with_table else ()
    rows = _csv_by_name(spark, found, schemas.CREDIT, extra) if found else None
    if rows is not None and with_table:
        dated = rows.withColumn("_date", _file_date(F.col("_stem")))
        return dated.withColumn("snapshot_table", snapshot_table(F.col("_stem"), F.col("_date"))).drop("_stem", "_date")
    if rows is not None:
        return rows
    schema = schemas.CREDIT
    if with_table:
        schema = T.StructType([*schema.fields, T.StructField("snapshot_table", T.StringType())])
    return spark.createDataFrame([], schema)


def entry_paths(found: DataFrame) -> list[str]:
    """One file per snapshot table (the first by name), as paths; a few rows of metadata."""
    firsts = found.groupBy("snapshot_table").agg(F.min("entry").alias("entry"))
    return [row.entry for row in firsts.orderBy("snapshot_table").collect()]


def _table(
    spark: SparkSession, base: str, schema: T.StructType, renames: dict[str, str] | None = None,
    multiline: bool = False,
) -> DataFrame | None:
    """``base``.parquet or ``base``.csv, or None if neither exists."""
    try:
        stored = spark.read.parquet(f"{base}.parquet").withColumnsRenamed(renames or {})
        return stored.select(*(
            (nan_to_null(F.col(f"`{f.name}`")) if f.dataType == T.DoubleType() else F.col(f"`{f.name}`"))
            .cast(f.dataType).alias(f.name)
            for f in schema.fields
        ))
    except AnalysisException as error:
        if not is_missing(error):
            raise
    try:
        rows = _csv_by_name(spark, [f"{base}.csv"], schema, renames=renames, multiline=multiline)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None
    if rows is None:
        raise ValueError(f"{base}.csv has no header")
    return rows


def sheet(spark: SparkSession, raw_dir: str, name: str) -> DataFrame | None:
    """One sheet of the workbook, or None if it is absent."""
    return _table(spark, f"{raw_dir}/{WORKBOOK}/{name}", schemas.SHEETS[name][1])


def sheet_tables(spark: SparkSession, raw_dir: str) -> dict[str, DataFrame]:
    """The four customer tables. All are empty if the workbook is absent; a missing sheet is an error."""
    found = {
        table: sheet(spark, raw_dir, name) for name, (table, _) in schemas.SHEETS.items()
    }
    missing = [table for table, df in found.items() if df is None]
    if missing and len(missing) < len(found):
        raise FileNotFoundError(f"workbook without sheet for {', '.join(missing)}")
    if not missing:
        return found
    log.warning("%s not found, its tables are empty", WORKBOOK)
    return {table: spark.createDataFrame([], schema) for table, schema in schemas.SHEETS.values()}


def survey(spark: SparkSession, raw_dir: str, headers: dict[str, str] | None = None) -> DataFrame:
    """Survey responses, empty if there is no file; ``headers`` maps question texts to columns.

    Answers may hold line breaks, so a CSV part file is read by one task.
    """
    found = _table(spark, f"{raw_dir}/{SURVEY_FILE}", schemas.SURVEY, headers, multiline=True)
    if found is None:
        log.warning("%s not found, the table is empty", SURVEY_FILE)
        return spark.createDataFrame([], schemas.SURVEY)
    return found


def _exists(spark: SparkSession, base: str) -> bool:
    """Whether ``base``.parquet or ``base``.csv is there; only names are listed."""
    for kind in ("parquet", "csv"):
        try:
            spark.read.format("binaryFile").load(f"{base}.{kind}")
            return True
        except AnalysisException as error:
            if not is_missing(error):
                raise
    return False


def present(spark: SparkSession, raw_dir: str) -> set[str]:
    """The sheet and survey tables that have a file."""
    bases = {table: f"{WORKBOOK}/{name}" for name, (table, _) in schemas.SHEETS.items()} | {"nps_data": SURVEY_FILE}
    return {table for table, base in bases.items() if _exists(spark, f"{raw_dir}/{base}")}


def load_raw(
    spark: SparkSession, raw_dir: str, survey_headers: dict[str, str] | None = None,
    credit_data: DataFrame | None = None,
) -> RawTables:
    """All raw inputs of a folder; ``credit_data`` replaces the scan of the snapshot files."""
    sheets = sheet_tables(spark, raw_dir)

    def facts() -> DataFrame:
        if credit_data is not None:
            return credit_data
        return credit_scan(spark, entry_paths(discover(spark, raw_dir)))

    return RawTables(
        credit_data=facts, nps_data=lambda: survey(spark, raw_dir, survey_headers),
        **{table: partial(sheets.__getitem__, table) for table in sheets},
    )
