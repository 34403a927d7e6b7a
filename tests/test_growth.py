"""What grows with the input: folders are made by many tasks, per-document values and rejects write no wide table, and stages
are compiled."""

import re
import time
from pathlib import Path

from conftest import SF_SMALL, base_row, lines_df
from pyspark.sql import functions as F

from ledgerline.functions.text import packed_texts, unpacked_texts
from ledgerline.operators.ordering import ordered_row_number
from ledgerline.params import JobParams
from ledgerline.plans import catalog, normalize
from ledgerline.plans.run import existing_outputs, run_manifest
from ledgerline.session import drop_materialized, materialize, settings
from ledgerline.sources import fixture
from ledgerline.sources.bills import list_files, read_bills


def test_output_folders_are_made_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: str(tmp_path / name))
    found = catalog.q_s3(spark, SF_SMALL)
    files = list((tmp_path / "outputs").glob("output=*/part-*.csv"))
    assert found.count() == len(files) > 1
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in files}) > 1


ROWS = [
    base_row(row_ord=0, document_id="D1"),
    base_row(row_ord=1, document_id="D1", charge_amount="x", bill_to_date="2023-02-28"),
    base_row(row_ord=1, document_id="D1", charge_amount="7", bill_to_date="2023-02-28"),  # repeats a row's number
    base_row(row_ord=2, document_id="D2", bill_to_date=None),
    base_row(row_ord=3, document_id="D2", service_id=None, invoice_date="soon"),
    base_row(row_ord=4, document_id="D3", billing_account_number=None, charge_type="NON-RECURRING"),
    base_row(row_ord=None, document_id="D3", discount_amount="-"),
]


def _written(monkeypatch):
    names, write = [], normalize.materialize
    monkeypatch.setattr(normalize, "materialize", lambda df, name: (names.append(name), write(df, name))[1])
    return names


def test_document_values_write_no_groups(spark, monkeypatch):
    names = _written(monkeypatch)
    lines = lines_df(spark, ROWS)
    alone = normalize.normalize_bills(lines, JobParams())
    got = sorted(map(str, alone.doc_stats.collect()))
    assert names == ["doc-stats"]
    both = normalize.normalize_bills(lines, JobParams())
    both.rows.count()
    assert got == sorted(map(str, both.doc_stats.collect())) and len(got) == 3
    assert names == ["doc-stats", "w1-groups", "doc-stats"]


def test_rejects_write_only_rejects(spark, monkeypatch):
    names = _written(monkeypatch)
    norm = normalize.normalize_bills(lines_df(spark, ROWS), JobParams(keep_rejects=True))
    assert sorted((r.document_id, r.row_ord, r.errors) for r in norm.rejects.collect()) == [
        ("D1", 1, ["CHARGE_AMOUNT_NOT_NUMERIC"]), ("D2", 3, ["INVOICE_DATE_UNPARSEABLE"])]
    assert names == ["rejects"]


def test_stages_stay_below_what_the_jvm_compiles(spark):
    catalog.queries()["p1_parse"](spark, SF_SMALL)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_a_record_is_cut_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Billing Account Number,Units,Charge Amount\nA1,2,3\n,,\nA2,NA,4,extra\n")
    (tmp_path / "b.csv").write_text("Units,Billing Account Number\n5,B1\n")
    rows, _ = read_bills(spark, str(tmp_path))
    got = sorted((r.billing_account_number, r.units, r.charge_amount, r.row_too_long) for r in rows.collect())
    assert got == [("A1", "2", "3", False), ("A2", None, "4", True), ("B1", "5", None, False)]
    # in the whole plan once for each of the two widths, not for each use of a cell
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_csv(") == 2


def _shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    header = ["Billing Account Number", "Charge Description", "Charge Amount", "Discount Amount", "Invoice Date", "Bill From Date", "Bill To Date", "Units"]
    cells = ["1", "Plain", "10", "0", "2023-01-17", "2023-01-01", "2023-01-31", "2"]
    (src / "DOC-1-a.csv").write_text("\n".join(map(",".join, [header, cells, cells])) + "\n")
    manifest = spark.createDataFrame([(0, "DOC-1-a.csv", "a")], "manifest_ord int, file_name string, document_id string")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, kept = _shuffle_files(spark), spark.conf.get(key)
    result = run_manifest(spark, manifest, str(src), str(tmp_path / "dst"), JobParams())
    for _ in range(50):  # they go in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(key) == kept
    assert [(r.status, r.n_rows) for r in result.status.collect()] == [("Success", 2)]


def test_one_time_rows_carry_no_values(spark, monkeypatch):
    shuffled = []
    monkeypatch.setattr(normalize, "materialize", lambda df, name: shuffled.append(df) or df)
    rows = [base_row(row_ord=0), base_row(row_ord=1, charge_type="NON-RECURRING"), base_row(row_ord=2, charge_type=None)]
    kept = normalize.normalize_bills(lines_df(spark, rows), JobParams()).rows
    assert "_key" not in shuffled[0].columns and kept.count() == 1
    assert ", v, CASE WHEN" in shuffled[0]._jdf.queryExecution().optimizedPlan().toString()


def test_packed_texts_sort_as_their_columns(spark):
    texts = [None, "", "a", "ab", "a\0", "\0", "\1", "\2", "\0\1", "\1\0", "\1\1", "\1\2", "é"]
    rows = spark.createDataFrame([(a, b, c) for a in texts for b in texts for c in (None, "", "x")], "a string, b string, c string")
    got = rows.withColumn("p", packed_texts([F.col(c) for c in "abc"])).withColumn("u", unpacked_texts(F.col("p"))).collect()
    assert all(r.u == [r.a, r.b, r.c] for r in got)
    key = lambda r: [(x is not None, (x or "").encode()) for x in (r.a, r.b, r.c)]
    assert sorted(got, key=key) == sorted(got, key=lambda r: r.p.encode())


def test_one_time_rows_are_one_group_of_their_document(spark):
    rows = [base_row(row_ord=i, service_id=f"S{i}", charge_type="NON-RECURRING" if i else "Recurring") for i in range(4)]
    norm = normalize.normalize_bills(lines_df(spark, rows), JobParams())
    assert norm.rows.count() == 1 and norm._groups.count() == 2
    assert [(r.n_rows, r.n_kept) for r in norm.doc_stats.collect()] == [(4, 1)]


def test_equal_rows_tie_goes_by_their_texts(spark):
    rows = [base_row(row_ord=1, charge_amount=c, discount_amount=d) for c, d in (("9", None), ("10", "1"), ("9", "\x00"), ("9", "\x01"))]
    norm = normalize.normalize_bills(lines_df(spark, rows), JobParams())
    assert norm._groups.select("w1.charge_amount", "w1.discount_amount", "w1.row_ord").first() == ("9", "\x01", 1)


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    kept = materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "probe")
    for _ in range(50):  # they go in the background
        left = _shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept.count() == 7
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    drop_materialized(kept)
    assert not folder.exists()


def test_status_reads_the_tables_once(spark):
    found = catalog.fixture_status(spark, SF_SMALL)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "c_custkey" not in plan  # lines and decisions are written, not computed again
    assert found.count() == 13


def test_rows_are_not_shuffled_to_be_shifted(spark):
    rows = spark.createDataFrame([(f"D{i % 2}", i, str(i % 5), None if i % 3 else "t") for i in range(40)], "d string, i int, s string, t string")
    found = ordered_row_number(rows, ["d"], [F.col("i").desc()], num_partitions=3, pack=["s", "t"])
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(f"D{i % 2}", i, str(i % 5), None if i % 3 else "t", (39 - i) // 2 + 1) for i in range(40)}
    assert found.columns == ["d", "i", "s", "t", "row_number"] and {tuple(r) for r in found.collect()} == want


def test_many_small_files_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"output=a{i}").mkdir()
        (tmp_path / f"output=a{i}" / "part-0.csv").write_text("x\n")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "1m"}):
        files = list_files(spark, str(tmp_path))
        assert files.rdd.getNumPartitions() < 10 and {r.size for r in files.collect()} == {2}
        assert {r.output for r in existing_outputs(spark, str(tmp_path)).collect()} == {f"a{i}" for i in range(40)}


def test_fixture_files_are_written_from_a_table_that_goes(spark, monkeypatch):
    made, write = [], fixture.materialize
    monkeypatch.setattr(fixture, "materialize", lambda df, name: (made.append(write(df, name)), made[-1])[1])
    catalog.write_fixture_csv(spark, SF_SMALL)
    assert len(made) == 1 and not Path(made[0].inputFiles()[0].removeprefix("file://")).exists()


def test_written_rows_need_no_group_table(spark):
    norm = normalize.normalize_bills(lines_df(spark, ROWS[:3]), JobParams())
    assert norm.rows.count() == 0  # one amount is no number
    groups = Path(norm._groups.inputFiles()[0].removeprefix("file://")).parent
    norm.drop_groups()
    assert not groups.exists() and [r.n_rows for r in norm.doc_stats.collect()] == [3]
