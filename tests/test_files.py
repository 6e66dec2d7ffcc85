"""File discovery, scans by column name, missing sources, load-once, exports."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanscope import pipeline, registry
from loanscope.plans import marts, quality, staging
from loanscope.sinks import export, tables
from loanscope.sources import catalog, files, sample_files, schemas
from loanscope.sources.derived import raw_tables as derived_tables
from loanscope.sources.scratch import scratch_dir
from loanscope.streaming import ingest
from tests import samples

CREDIT_COLUMNS = schemas.CREDIT.fieldNames()


def credit_line(loan, columns=CREDIT_COLUMNS, **values):
    row = {**samples.CREDIT_DEFAULTS, "loan_id": loan, **values}
    return ",".join(str(row.get(column, "")) for column in columns)


def write_csv(path, lines, columns=CREDIT_COLUMNS):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(columns), *lines]) + "\n")


def loans(df):
    return sorted(row.loan_id for row in df.select("loan_id").collect())


@pytest.mark.parametrize(("stem", "table"), [
    ("Credit Data - 01-02-2025", "credit_data_20250201"),
    ("Credit Data - 30-03-2025 (copy)", "credit_data_20250330"),
    ("Credit Data - Latest", "credit_data___latest"),
    ("Credit Data - 1-2-2025", "credit_data___1_2_2025"),
])
def test_snapshot_table(spark, stem, table):
    df = spark.createDataFrame([(stem,)], "stem string")
    assert df.select(files.snapshot_table(F.col("stem"))).first()[0] == table


def test_table_names_cost_little_per_row(spark, tmp_path):
    write_csv(tmp_path / "Credit Data - 31-03-2025 a+b%20c.csv" / "part-0.csv", [credit_line("B")])
    write_csv(tmp_path / "Credit Data - New +%.csv", [credit_line("C")])
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))), with_table=True)
    assert sorted((r.loan_id, r.snapshot_table) for r in scan.collect()) == [("B", "credit_data_20250331"), ("C", "credit_data___new_+%")]
    plan = scan._jdf.queryExecution().optimizedPlan()
    assert "file_path" not in plan.toString()
    # the name is taken apart once, its date found in a projection above
    assert plan.toString().count("Project [") >= 3


def test_orders_after_the_last_snapshot_are_not_repeated(spark, sf_dir):
    plan = derived_tables(spark, sf_dir).credit_data._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderdate" in plan.split("Generate")[1].split("Filter ")[1].split("\n")[0]


def test_discovery_ignores_other_files(spark, tmp_path):
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", [credit_line("A")])
    write_csv(tmp_path / "Credit Data - 31-03-2025.csv" / "part-0.csv", [credit_line("B")])
    write_csv(tmp_path / "Credit Data - 31-03-2025.csv" / "part-1.csv", [credit_line("C")])
    write_csv(tmp_path / "Credit Notes.csv", [credit_line("X")])
    found = files.discover(spark, str(tmp_path))
    assert sorted(r.snapshot_table for r in found.collect()) == ["credit_data_20250101", "credit_data_20250331"]
    scan = files.credit_scan(spark, files.entry_paths(found), with_table=True)
    assert sorted((r.loan_id, r.snapshot_table) for r in scan.collect()) == [
        ("A", "credit_data_20250101"), ("B", "credit_data_20250331"), ("C", "credit_data_20250331"),
    ]


def test_columns_are_matched_by_name(spark, tmp_path):
    shuffled = ["extra", *reversed([c.upper() if c == "customer_age" else c for c in CREDIT_COLUMNS])]
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", [credit_line("A", balance="5", days_past_due="3.0")])
    lower = [c.lower() for c in shuffled]
    write_csv(tmp_path / "Credit Data - 31-03-2025.csv",
              [credit_line("B", lower, balance="7", customer_age="40", extra="x")], shuffled)
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))))
    rows = {r.loan_id: r for r in scan.collect()}
    assert scan.columns == CREDIT_COLUMNS
    assert (rows["A"].balance, rows["A"].days_past_due, rows["A"].customer_age) == (5.0, 3, None)
    assert (rows["B"].balance, rows["B"].customer_age) == (7.0, 40)


def jobs_of(spark, group, act):
    spark.sparkContext.setJobGroup(group, group)
    try:
        act()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_part_files_of_one_entry_may_differ(spark, tmp_path):
    entry = tmp_path / "Credit Data - 01-01-2025.csv"
    turned = ["extra", *reversed(CREDIT_COLUMNS)]
    write_csv(entry / "part-0.csv", [credit_line("A", balance="5"), credit_line("B", balance="6")])
    write_csv(entry / "part 1+2%.csv", [credit_line("C", turned, balance="7", extra='"x,y"')], turned)
    (entry / "part-2.csv").write_text("")
    write_csv(entry / "part-3.csv", [])
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))), with_table=True)
    assert sorted((r.loan_id, r.balance, r.snapshot_table) for r in scan.collect()) == [
        (loan, balance, "credit_data_20250101") for loan, balance in (("A", 5.0), ("B", 6.0), ("C", 7.0))
    ]


def test_files_without_a_line(spark, tmp_path):
    (tmp_path / "Credit Data - 01-01-2025.csv").write_text("")
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))), with_table=True)
    assert scan.count() == 0 and scan.columns == [*CREDIT_COLUMNS, "snapshot_table"]
    (tmp_path / files.WORKBOOK).mkdir()
    (tmp_path / files.WORKBOOK / "DOB.csv").write_text("\n")
    with pytest.raises(ValueError, match="no header"):
        files.sheet(spark, str(tmp_path), "DOB")


def test_headers_cost_the_same_jobs_for_many_entries(spark, tmp_path):
    def entries(folder, n):
        for k in range(n):
            write_csv(tmp_path / folder / f"Credit Data - {k % 28 + 1:02d}-{k // 28 + 1:02d}-2025.csv", [credit_line(f"L{k}")])
        return [str(path) for path in sorted((tmp_path / folder).iterdir())]

    few, many = entries("few", 40), entries("many", 200)
    counts = {}
    for name, paths in (("few", few), ("many", many)):
        counts[name] = jobs_of(spark, f"headers-{name}", lambda: files.headers(spark, paths).collect())
    assert counts["few"] == counts["many"] <= 2
    assert files.credit_scan(spark, many).count() == 200


def test_a_long_file_is_one_partition_of_headers(spark, tmp_path):
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", [credit_line(f"L{k}") for k in range(60_000)])
    found = files.headers(spark, [str(tmp_path)])
    assert found.rdd.getNumPartitions() == 1
    assert [list(r.names) for r in found.collect()] == [CREDIT_COLUMNS]


def test_one_line_of_a_file_leaves_the_scan_for_its_header(spark, tmp_path, monkeypatch):
    (tmp_path / "Credit Data - 01-01-2025.csv").mkdir()
    for n in range(2):
        write_csv(tmp_path / "Credit Data - 01-01-2025.csv" / f"part-{n}.csv", ["", " \t", *(credit_line(f"L{k}") for k in range(300))], ["", *CREDIT_COLUMNS][n:])

    def whole(source):
        for batch in source:
            paths, lines = (column.to_pylist() for column in batch.columns)
            yield pa.record_batch([pa.array(paths), pa.array([[line] for line in lines], pa.list_(pa.string()))], names=["path", "names"])

    monkeypatch.setattr(files, "_first_lines", whole)
    found = files.headers(spark, [str(tmp_path / "Credit Data - 01-01-2025.csv")]).collect()
    assert sorted(r.names[0] for r in found) == sorted([",".join(["", *CREDIT_COLUMNS]), ",".join(CREDIT_COLUMNS)])


def test_rows_of_a_snapshot_are_dealt_over_compressed_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sample_files.CSV_PARTS, "maxRecordsPerFile", 10)
    raw = files.load_raw(spark, str(tmp_path))
    rows = spark.range(25).selectExpr("concat('L', id) as loan_id", "id as balance").coalesce(1)
    rows = raw.credit_data.drop("loan_id", "balance").unionByName(rows, allowMissingColumns=True).select(*CREDIT_COLUMNS)
    sample_files.write_snapshot(rows, str(tmp_path), "credit_data_20250101")
    assert len(list((tmp_path / "Credit Data - 01-01-2025.csv").glob("*-c00[012].csv.snappy"))) >= 3
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))), with_table=True)
    assert {(r.loan_id, r.balance, r.snapshot_table) for r in scan.collect()} == {(f"L{n}", n, "credit_data_20250101") for n in range(25)}


def test_missing_column_fails(spark, tmp_path):
    columns = [c for c in CREDIT_COLUMNS if c != "balance"]
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", [credit_line("A", columns)], columns)
    with pytest.raises(Exception, match="balance"):
        files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))))


def test_not_available_texts_become_null(spark, tmp_path):
    lines = [credit_line("A", balance="NaN"), credit_line("#N/A", balance="N/A"), credit_line("B", balance="1.5")]
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", lines)
    scan = files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path))))
    assert sorted(((r.loan_id, r.balance) for r in scan.collect()), key=str) == [
        ("A", None), ("B", 1.5), (None, None),
    ]


def test_bad_number_fails(spark, tmp_path):
    write_csv(tmp_path / "Credit Data - 01-01-2025.csv", [credit_line("A", balance="much")])
    with pytest.raises(Exception):
        files.credit_scan(spark, files.entry_paths(files.discover(spark, str(tmp_path)))).collect()


def test_missing_sources_are_empty(spark, tmp_path):
    raw = files.load_raw(spark, str(tmp_path))
    for table, schema in schemas.RAW_TABLES.items():
        df = getattr(raw, table)
        assert df.schema.fieldNames() == schema.fieldNames()
        assert df.count() == 0


def test_workbook_without_a_sheet_fails(spark, tmp_path):
    write_csv(tmp_path / files.WORKBOOK / "DOB.csv", ["L1,2000-01-01"], ["Loan Id ", "date_of_birth"])
    with pytest.raises(FileNotFoundError, match="customer_sales"):
        files.sheet_tables(spark, str(tmp_path))


def test_survey_headers_and_line_breaks(spark, tmp_path):
    headers = schemas.survey_headers("Acme", "AcmeApp")
    question = {column: text for text, column in headers.items()}
    names = [question.get(name, name) for name in schemas.SURVEY.fieldNames()]
    values = {"Loan Id": "L1", "Submission ID": "7", "Submitted at": "2025-01-02 03:04:05", "nps_score": "9",
              "additional_feedback": '"two\nlines, ""quoted"""'}
    line = ",".join(values.get(name, "") for name in schemas.SURVEY.fieldNames())
    quoted = [f'"{name}"' for name in names]
    write_csv(tmp_path / f"{files.SURVEY_FILE}.csv", [line], quoted)
    row = staging.survey(files.survey(spark, str(tmp_path), headers)).first()
    assert (row.loan_id, row.nps_score, row.nps_category) == ("L1", 9, "Promoter")
    assert row.submitted_at == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert row.additional_feedback == 'two\nlines, "quoted"'


def test_ingest_loads_each_table_once(spark, tmp_path):
    raw_dir, target = tmp_path / "raw", str(tmp_path / "target")
    write_csv(raw_dir / "Credit Data - 01-01-2025.csv", [credit_line("A")])
    ingest.ingest(spark, str(raw_dir), target)
    ingest.ingest(spark, str(raw_dir), target)
    assert loans(ingest.facts(spark, target)) == ["A"]

    write_csv(raw_dir / "Credit Data - 01-01-2025 v2.csv", [credit_line("Z")])
    write_csv(raw_dir / "Credit Data - 31-03-2025.csv", [credit_line("B"), credit_line("B")])
    ledger = ingest.ingest(spark, str(raw_dir), target)
    assert loans(ingest.facts(spark, target)) == ["A", "B", "B"]
    assert sorted((r.snapshot_table, r.action) for r in ledger.collect()) == [
        ("credit_data_20250101", "loaded"), ("credit_data_20250101", "skipped"), ("credit_data_20250331", "loaded"),
    ]


def test_ingest_repeats_a_lost_batch(spark, tmp_path):
    """A batch whose commit was lost runs again and ends with the same rows."""
    raw_dir, target = tmp_path / "raw", tmp_path / "target"
    write_csv(raw_dir / "Credit Data - 01-01-2025.csv", [credit_line("A"), credit_line("A")])
    ingest.ingest(spark, str(raw_dir), str(target))
    for commit in (target / ingest.CHECKPOINT / "commits").iterdir():
        commit.unlink()
    ingest.ingest(spark, str(raw_dir), str(target))
    assert loans(ingest.facts(spark, str(target))) == ["A", "A"]
    assert [r.action for r in ingest.ledger(spark, str(target)).collect()] == ["loaded"]


def test_ingest_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert ingest.ingest(spark, str(tmp_path / "raw"), str(tmp_path / "target")).count() == 0


def test_exports_are_ordered_and_isolated(spark, tmp_path):
    raw = samples.raw_tables(
        spark,
        credit_data=[{"loan_id": f"L{i}", "balance": 1.0, "total_paid": 2.0} for i in range(5)],
        customer_sales=[{"Loan Id": f"L{9 - i % 4}", "sale_id": i} for i in range(40)],
    )

    def broken(raw):
        return raw.credit_data.select("no_such_column")

    exports = (export.EXPORTS[0], export.Export("broken", broken), *export.EXPORTS[3:])
    status = export.export_all(spark, raw, str(tmp_path), exports).collect()
    assert [(r.export, r.status, r.rows) for r in status] == [
        ("mart_portfolio_performance", "OK", 1), ("broken", "SKIP", None), ("stg_customers", "OK", 40),
        ("SUMMARY", "OK", 5),
    ]
    parts = sorted((tmp_path / "stg_customers.csv").glob("part-*.csv"))
    ids = [line.split(",")[0] for part in parts for line in part.read_text().splitlines()[1:]]
    assert len(ids) == 40 and ids == sorted(ids)


def test_catalog(spark, tmp_path):
    rows = [{"loan_id": "A"}, {"loan_id": "B"}]
    df = samples.table(spark, "credit_data", rows)
    names = ("credit_data_19990101", "credit_data___x", "creditXdata_1")
    for name in names:
        df.createOrReplaceTempView(name)
    found = [name for name in catalog.snapshot_tables(spark) if name in names]
    assert found == ["credit_data_19990101", "credit_data___x"]
    assert [tuple(r) for r in catalog.row_counts(spark, found).collect()] == [(name, 2) for name in found]
    assert catalog.union_snapshots(spark, found).count() == 4
    assert catalog.union_snapshots(spark, []).columns == CREDIT_COLUMNS
    for name in names:
        spark.catalog.dropTempView(name)


def test_load_once_table(spark, tmp_path):
    one, two = spark.range(1), spark.range(2)
    try:
        assert tables.load_once(spark, "loaded_once", one, str(tmp_path / "t"))
        assert not tables.load_once(spark, "loaded_once", two, str(tmp_path / "t"))
        assert spark.table("loaded_once").count() == 1
    finally:
        spark.sql("drop table if exists loaded_once")


def test_scratch_is_below_the_checkpoint_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    first = scratch_dir(spark)
    assert first != scratch_dir(spark) and spark.conf.get("spark.checkpoint.dir", None) == before
    if before is None:
        spark.conf.set("spark.checkpoint.dir", "file:/tmp/shared")
        assert scratch_dir(spark).startswith("file:/tmp/shared/")
        spark.conf.unset("spark.checkpoint.dir")


def test_late_part_files_are_added(spark, tmp_path):
    """Part files of a known entry are added whenever they come; other entries for its table are not."""
    raw_dir, target = tmp_path / "raw", str(tmp_path / "target")
    folder = raw_dir / "Credit Data - 01-01-2025.csv"
    write_csv(folder / "part-0.csv", [credit_line("A"), credit_line("B")])
    ingest.ingest(spark, str(raw_dir), target)
    write_csv(folder / "part-1.csv", [credit_line("C"), credit_line("D")])
    write_csv(raw_dir / "Credit Data - 01-01-2025 v2.csv" / "part-0.csv", [credit_line("Z")])
    ingest.ingest(spark, str(raw_dir), target)
    assert loans(ingest.facts(spark, target)) == ["A", "B", "C", "D"]
    write_csv(raw_dir / "Credit Data - 01-01-2025 v2.csv" / "part-1.csv", [credit_line("Y")])
    ingest.ingest(spark, str(raw_dir), target)
    commits = [path for path in (tmp_path / "target" / ingest.CHECKPOINT / "commits").iterdir()]
    last = max(int(path.name) for path in commits if path.name.isdigit())
    for path in commits:
        if path.name.strip(".crc") == str(last):
            path.unlink()  # the last batch is lost and runs again
    ledger = ingest.ingest(spark, str(raw_dir), target)
    assert loans(ingest.facts(spark, target)) == ["A", "B", "C", "D"]
    assert sorted((r.path.rsplit("/", 2)[1:], r.action) for r in ledger.collect()) == [
        (["Credit Data - 01-01-2025 v2.csv", "part-0.csv"], "skipped"),
        (["Credit Data - 01-01-2025 v2.csv", "part-1.csv"], "skipped"),
        (["Credit Data - 01-01-2025.csv", "part-0.csv"], "loaded"),
        (["Credit Data - 01-01-2025.csv", "part-1.csv"], "loaded"),
    ]


def test_latest_ingested_facts_are_pruned(spark, tmp_path):
    raw_dir, target = tmp_path / "raw", str(tmp_path / "target")
    for day in ("01-01-2025", "31-03-2025"):
        write_csv(raw_dir / f"Credit Data - {day}.csv", [credit_line(day, date=f"{int(day[3:5])}/{int(day[:2])}/2025")])
    ingest.ingest(spark, str(raw_dir), target)
    newest = ingest.latest_facts(spark, target)
    assert loans(newest) == ["31-03-2025"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert ingest.facts(spark, str(tmp_path / "none")).count() == 0


def test_bad_dates_fail_without_ansi(spark, tmp_path):
    rows = samples.table(spark, "credit_data", [{"loan_id": "A", "date": "13/1/2025"}])
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="bad date"):
            staging.credit_snapshots(rows).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_pipeline_without_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    result = pipeline.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert {name: result[name].count() for name in pipeline.MARTS} == dict.fromkeys(pipeline.MARTS, 0)


def test_pipeline(spark, sf_dir):
    raw, folder, out = derived_tables(spark, sf_dir), scratch_dir(spark), scratch_dir(spark)
    for write in (sample_files.write_snapshots, sample_files.write_sheets, sample_files.write_survey):
        write(raw, folder)
    result = pipeline.run(spark, folder, out, sample_files.SAMPLE_HEADERS)
    assert result["mart_portfolio_performance"].count() == 5
    assert {r.status for r in result["exports"].collect()} == {"OK"}
    assert result["ledger"].where("action = 'loaded'").count() == 5
    again = pipeline.run(spark, folder, out, sample_files.SAMPLE_HEADERS)
    assert again["ledger"].count() == 5
    failing = {(r.model, r.column_name): r.failing_rows for r in again["not_null"].collect()}
    assert failing["stg_nps", "nps_score"] > 0 and failing["stg_customers", "loan_id"] == 0
    rows = lambda df: sorted(map(tuple, df.collect()))
    for name, check in (("not_null", quality.not_null), ("accepted_values", quality.accepted_values), ("unique", quality.unique)):
        assert rows(again[name]) == rows(check(raw)), name
        # counted while the models were stored: nothing is scanned again, but the key of unique()
        scanned = [path for path in again[name].inputFiles() if "/models/stg_customers/" not in path]
        assert not scanned and (name == "unique" or not again[name].inputFiles())
    assert rows(again["mart_credit_vs_nps"]) == rows(marts.credit_vs_nps(raw))


def test_stored_inputs_stay_when_their_files_go(spark, tmp_path):
    raw_dir, out = tmp_path / "raw", str(tmp_path / "out")
    raw = samples.raw_tables(
        spark, customer_sales=[{"Loan Id": "A", "sale_id": 1}, {"Loan Id": "B", "sale_id": 2}], nps_data=[{"Loan Id": "A", "nps_score": 9}],
    )
    sample_files.write_sheets(raw, str(raw_dir))
    sample_files.write_survey(raw, str(raw_dir))
    counts = lambda: [getattr(pipeline.stored_inputs(spark, str(raw_dir), out, raw.credit_data, sample_files.SAMPLE_HEADERS), name).count() for name in ("customer_sales", "customer_dob", "nps_data")]
    assert counts() == [2, 0, 1]
    sample_files.remove_sheets_and_survey(spark, str(raw_dir))
    assert not files.present(spark, str(raw_dir))
    assert counts() == [2, 0, 1]


def test_named_tables_run_the_pipeline_twice(spark, sf_dir, monkeypatch):
    runs, run = [], pipeline.run

    def watched(spark, raw_dir, *args):
        present = files.present(spark, raw_dir)
        runs.append((len(present), run(spark, raw_dir, *args)))
        return runs[-1][1]

    monkeypatch.setattr(pipeline, "run", watched)
    named = registry.queries()["sink_named_tables"](spark, sf_dir)
    assert [present for present, _ in runs] == [5, 0]
    assert {r.table_name for r in named.collect() if r.kept} == schemas.RAW_TABLES.keys() - {"credit_data"}
    rows = lambda df: sorted(map(str, df.collect()))
    for name, want in (("mart_cohort_analysis", marts.cohort_analysis), ("mart_credit_vs_nps", marts.credit_vs_nps)):
        assert rows(runs[1][1][name]) == rows(want(derived_tables(spark, sf_dir)))  # the stored customers count on
    assert {r.status for r in runs[1][1]["exports"].collect()} == {"OK"}


def test_checks_of_batches_that_were_not_counted(spark, tmp_path):
    raw_dir, target = tmp_path / "raw", tmp_path / "target"
    write_csv(raw_dir / "Credit Data - 01-01-2025.csv", [credit_line("A"), credit_line("")])
    ingest.ingest(spark, str(raw_dir), str(target))
    first = ingest.check_results(spark, str(target))
    assert first == [("not_null", "stg_credit_snapshots", "loan_id", 1), ("not_null", "stg_credit_snapshots", "snapshot_date", 0)]
    (target / ingest.CHECKS).rename(target / "elsewhere")  # as a table of before has none
    write_csv(raw_dir / "Credit Data - 31-03-2025.csv", [credit_line("")])
    ingest.ingest(spark, str(raw_dir), str(target))
    assert [row[3] for row in ingest.check_results(spark, str(target))] == [2, 0]
