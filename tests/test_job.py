"""Composed plan and run: golden document checks (FIXTURES §4.3, 4.4, 4.6) and properties."""

import json
import os

from pyspark.sql import functions as F

from conftest import base_row, lines_df
from ledgerline import fixed
from ledgerline.operators.dedupe import latest_per_key
from ledgerline.params import JobParams
from ledgerline.plans.normalize import normalize_bills
from ledgerline.plans.run import run_job


def _norm(spark, rows, **kw):
    return normalize_bills(lines_df(spark, rows), JobParams(vendor="V"), **kw)


def test_keep_latest_golden(spark):
    rows = [
        base_row(charge_description="k", bill_to_date="2023-01-31", charge_type="Recurring", charge_amount="1"),
        base_row(charge_description="k", bill_to_date="2023-02-28", charge_type="Usage", charge_amount="2"),
        base_row(charge_description="k", bill_to_date="2023-03-31", charge_type="Non-Recurring", charge_amount="3"),
        base_row(charge_description="m", bill_to_date=None, charge_type="Recurring", charge_amount="4"),
        base_row(charge_description="m", bill_to_date="2022-12-31", charge_type="Recurring", charge_amount="5"),
    ]
    out = _norm(spark, rows).rows.collect()
    assert sorted((r.product_name, r.unit_recurring_cost) for r in out) == [("k", 2.0), ("m", 5.0)]


def test_frequency_sentinel(spark):
    # Missing bill-to on the kept row: 1.0 when the document has other values, else missing.
    d1 = [base_row(charge_description="a", bill_to_date=None, document_id="D1"),
          base_row(charge_description="b", bill_to_date="2023-01-31", document_id="D1")]
    d2 = [base_row(charge_description="a", bill_to_date=None, document_id="D2")]
    out = {(r.document_id, r.product_name): r.billing_frequency for r in _norm(spark, d1 + d2).rows.collect()}
    assert out[("D1", "a")] == 1.0 and out[("D1", "b")] == 1.0 and out[("D2", "a")] is None


def test_extraction_date_is_first_row_before_one_time_filter(spark):
    rows = [base_row(invoice_date="2023-05-01", charge_type="NON-RECURRING", row_ord=0),
            base_row(invoice_date="2023-06-01", charge_description="x", row_ord=1)]
    out = _norm(spark, rows).rows.collect()
    assert [r.extraction_date for r in out] == ["2023-05-01"]


def test_row_error_fails_the_document(spark):
    rows = [base_row(document_id="A"), base_row(document_id="B"),
            base_row(document_id="B", charge_description="Business White Pages Listing none", row_ord=7)]
    n = _norm(spark, rows)
    assert {r.document_id for r in n.rows.collect()} == {"A"}
    stats = {r.document_id: r for r in n.doc_stats.collect()}
    assert stats["B"].pre_error.code == fixed.ERR_LISTING_WITHOUT_DASH and stats["B"].pre_error.row == 7


def test_money_error_only_on_kept_rows(spark):
    rows = [base_row(charge_amount="x", bill_to_date="2023-01-01", row_ord=0),  # dropped by W1
            base_row(charge_amount="10", bill_to_date="2023-02-01", row_ord=1)]
    assert _norm(spark, rows).rows.count() == 1


def test_w1_at_most_one_row_per_key_and_idempotent(spark):
    rows = [base_row(charge_description=f"k{i % 3}", bill_to_date=f"2023-0{1 + i % 5}-01", row_ord=i) for i in range(30)]
    df = lines_df(spark, rows)
    once = latest_per_key(df, ["document_id", "charge_description"], F.col("bill_to_date"), tie="row_ord")
    twice = latest_per_key(once, ["document_id", "charge_description"], F.col("bill_to_date"), tie="row_ord")
    assert once.groupBy("charge_description").count().filter("count > 1").count() == 0
    assert sorted(once.select("row_ord").collect()) == sorted(twice.select("row_ord").collect())


def test_output_does_not_depend_on_partitioning(spark):
    rows = [base_row(charge_description=f"d{i % 7}", service_id=f"S{i % 4}", units=str(i % 5),
                     bill_to_date=f"2023-0{1 + i % 9}-15", document_id=f"D{i % 3}", row_ord=i) for i in range(200)]
    df = lines_df(spark, rows)
    a = normalize_bills(df.coalesce(1), JobParams()).rows
    b = normalize_bills(df.repartition(13), JobParams()).rows
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.filter((F.col("service_quantity") < 1) | (F.col("billing_frequency") < 1)).count() == 0


def _write_csv(path, header, rows):
    import csv
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_run_document_checks(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    full = ["Billing Account Number", "Charge Description", "Charge Amount", "Discount Amount", "Invoice Date",
            "Bill From Date", "Bill To Date", "Charge Type Description", "Units", "Service ID (Supporting ID)"]
    good = [["1", "Port-Circuit ID: AB1 more", "$1,234.50", "(34.50)", "2023-01-17", "2023-01-01", "2023-01-31",
             "Recurring", "2", "SVC-1"],
            ["1", "Plain", "10", "0", "2023-01-17", "2023-01-01", "2023-03-17", "Usage", "", "SVC-2"]]
    _write_csv(src / "DOC-1-aaaa-good.csv", full, good)
    short = [h for h in full if h not in ("Charge Amount", "Invoice Date")]
    _write_csv(src / "DOC-2-bbbb-missing.csv", short, [["1", "x", "0", "2023-01-01", "2023-01-31", "Recurring", "1", "S"]])
    _write_csv(src / "DOC-3-cccc-empty.csv", full, [])
    _write_csv(src / "DOC-4-dddd-onetime.csv", full, [["1", "x", "5", "0", "2023-01-17", "2023-01-01", "2023-01-31",
                                                      "Non-Recurring", "1", "S"]])
    _write_csv(src / "DOC-6-ffff-done.csv", full, good)
    os.makedirs(dst / "output=DOC-6-ffff-done")
    (dst / "output=DOC-6-ffff-done" / "part-0.csv").write_text("x\n")
    os.makedirs(dst / "output=DOC-7-gggg-both")
    (dst / "output=DOC-7-gggg-both" / "part-0.csv").write_text("x\n")
    names = ["DOC-1-aaaa-good.csv", "DOC-2-bbbb-missing.csv", "DOC-3-cccc-empty.csv", "DOC-4-dddd-onetime.csv",
             "DOC-5-eeee-notfound.csv", "DOC-6-ffff-done.csv", "DOC-7-gggg-both.csv"]
    manifest = {"tenant_bridge_id": "t", "last_run_on_utc": None,
                "files": [{"file_name": n, "document_id": n.split("-")[2], "original_file_name": n, "display_id": n[:5]}
                          for n in names]}
    (tmp_path / "manifest.json").write_text(json.dumps(manifest))
    params = JobParams(vendor="V", client_name="C", upload_user="u", tenant_bridge_id="t", tenant_bridge_run_id="r")
    res = run_job(spark, str(tmp_path / "manifest.json"), str(src), str(dst), params,
                  run_ts=F.lit("2024-02-03 04:05:06").cast("timestamp_ntz"))
    got = {r.document_id: (r.status, r.error, r.extraction_date) for r in res.status.collect()}
    assert got["aaaa"] == ("Success", "", "2023-01-17")
    assert got["bbbb"] == ("Error", "Charge Amount, Invoice Date,  are missing.", "")
    assert got["cccc"] == ("Error", fixed.MSG_EMPTY_FILE, "")
    assert got["dddd"] == ("Error", fixed.MSG_EMPTY_AFTER_RULES, "")
    assert got["eeee"] == ("Error", fixed.MSG_NOT_AT_SOURCE, "")
    assert got["ffff"] == ("Error", fixed.MSG_ALREADY_DONE, "")
    assert got["gggg"] == ("Error", fixed.MSG_NOT_AT_SOURCE + fixed.MSG_ALREADY_DONE, "")
    # K1: the written sheet of DOC-1 has 8 preamble rows + 2 data rows, in sheet order.
    sheet = spark.read.csv(str(dst / "output=DOC-1-aaaa-good"))
    assert sheet.count() == 10
    ordered = [r for r in sheet.collect()]
    assert ordered[1]["_c1"] == fixed.SHEET_TITLE and ordered[5]["_c1"] == "03-Feb-2024 04:05:06"
    assert ordered[7]["_c36"] == "V-Custom:Toll Free Number"
    assert {r["_c37"] for r in ordered[8:]} == {"2023-01-17"}
    rec = json.loads(res.record.first().run_record)
    assert [f["document_id"] for f in rec["files"]] == [n.split("-")[2] for n in names] and rec["summary"] == "EOF"
    log = [r.log_entry for r in res.error_log.orderBy("log_ord").collect()]
    assert log[0] == f"File={src}/DOC-2-bbbb-missing.csv, Error=Charge Amount, Invoice Date,  are missing."


def test_status_rows_and_sheet_rows(spark):
    from ledgerline.plans import catalog
    from ledgerline.operators.sheet import PREAMBLE_ROWS, upload_sheet
    from ledgerline.functions.dates import stamp
    from conftest import SF_SMALL
    st = catalog.fixture_status(spark, SF_SMALL)
    manifest = catalog.fixture.fixture_manifest(spark, SF_SMALL)
    assert st.count() == manifest.count() == st.select("document_id").distinct().count()
    norm = catalog.flagship(spark, SF_SMALL)
    sheet = upload_sheet(norm, JobParams(), stamp(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    n_docs = norm.select("document_id").distinct().count()
    assert sheet.count() == norm.count() + PREAMBLE_ROWS * n_docs
    # sheet rows per document are 1..n without gaps
    per_doc = sheet.groupBy("document_id").agg(F.count("*").alias("n"), F.max("sheet_row").alias("m"),
                                               F.countDistinct("sheet_row").alias("d"))
    assert per_doc.filter((F.col("n") != F.col("m")) | (F.col("n") != F.col("d"))).count() == 0


def test_switches_raw_order_and_paren_negative(spark):
    rows = [base_row(charge_description="k", bill_to_date="2023-02-01", charge_amount="(10)", row_ord=0),
            base_row(charge_description="k", bill_to_date="12/31/2023", charge_amount="20", row_ord=1)]
    df = lines_df(spark, rows)
    parsed = normalize_bills(df, JobParams(vendor="V")).rows.first()
    assert parsed.unit_recurring_cost == 20.0  # 12/31/2023 is the later date
    raw = normalize_bills(df, JobParams(vendor="V", latest_order="raw", paren_negative=True)).rows.first()
    assert raw.unit_recurring_cost == -10.0  # '2023-02-01' > '12/31/2023' as text; (10) negates


def test_cleanup_scratch(spark):
    from ledgerline.session import cleanup_scratch, ensure_checkpoint_dir, materialize
    materialize(spark.range(10), "probe").count()
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/scratch")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert fs.exists(path)
    cleanup_scratch(spark)
    assert not fs.exists(path)
