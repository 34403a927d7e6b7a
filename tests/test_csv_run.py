"""The run from CSV files to sheets on files as users have them: names with
spaces and escapes, shared labels, namesakes, blank rows, quoted text, bad bytes."""

import json

from pyspark.sql import functions as F

from ledgerline import fixed
from ledgerline.functions.money import clean_money, floor_units, units_number
from ledgerline.functions.text import decode_key
from ledgerline.operators.status import run_record
from ledgerline.params import JobParams
from ledgerline.plans.run import run_manifest
from ledgerline.sources.bills import read_bills
from ledgerline.streaming.incremental import start_incremental
from test_job import _write_csv

HEADER = ["Billing Account Number", "Charge Description", "Charge Amount", "Discount Amount", "Invoice Date",
          "Bill From Date", "Bill To Date", "Units"]


def line(description="Plain", charge="10", account="1"):
    return [account, description, charge, "0", "2023-01-17", "2023-01-01", "2023-01-31", "2"]


def run(spark, tmp_path, names, **kw):
    manifest = spark.createDataFrame([(i, n, f"id{i}") for i, n in enumerate(names)], "manifest_ord int, file_name string, document_id string")
    res = run_manifest(spark, manifest, str(tmp_path / "src"), str(tmp_path / "dst"), JobParams(vendor="V"), **kw)
    return res, [(r.status, r.error) for r in res.status.orderBy("manifest_ord").collect()]


def sheet(spark, tmp_path, output):
    rows = spark.read.option("escape", '"').csv(str(tmp_path / "dst")).filter(F.col("output") == output)
    return [r for r in rows.collect() if r["_c1"] == "V"]


def test_names_labels_namesakes_and_blank_rows(spark, tmp_path):
    src = tmp_path / "src"
    (src / "old").mkdir(parents=True)
    odd = "DOC-1-aaaa-1 (CARRIER LIMITED) a%20b [x].csv"
    _write_csv(src / odd, HEADER, [line("odd"), [""] * len(HEADER), line("odd two")])
    _write_csv(src / "DOC-1-bbbb-y.csv", HEADER, [line("same label")])
    _write_csv(src / "x.csv", HEADER, [line("new", "7")])
    _write_csv(src / "old" / "x.csv", HEADER, [line("old", "9")])
    _write_csv(src / "blank.csv", HEADER, [[""] * len(HEADER)] * 2)
    res, got = run(spark, tmp_path, [odd, "DOC-1-bbbb-y.csv", "x.csv", "blank.csv", "old/x.csv", "gone.csv"])
    ok = ("Success", "")
    assert got[:4] == [ok, ok, ok, ("Error", fixed.MSG_EMPTY_FILE)] and got[5] == ("Error", fixed.MSG_NOT_AT_SOURCE)
    assert got[4] == ok and [r["_c3"] for r in sheet(spark, tmp_path, "x")] == ["old"]  # one output name: the last record's
    assert sorted(r["_c3"] for r in sheet(spark, tmp_path, odd.replace("%20", " ").replace(".csv", ""))) == ["odd", "odd two"]
    assert [r["_c3"] for r in sheet(spark, tmp_path, "DOC-1-bbbb-y")] == ["same label"]
    assert res.status.count() == 6 and {r.n_rows for r in res.status.filter("file_name = 'x.csv'").collect()} == {1}
    log = [r.log_entry for r in res.error_log.collect()]
    assert log == [f"File={src}/blank.csv, Error={fixed.MSG_EMPTY_FILE}"]
    again, got = run(spark, tmp_path, ["DOC-1-cccc-z.csv", "DOC-1-bbbb-y.csv"])
    assert got == [("Error", fixed.MSG_NOT_AT_SOURCE), ("Error", fixed.MSG_ALREADY_DONE)]


def test_dialect_and_bytes(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    texts = ['5" pipe, "big" one', "line one\nline two", "ends with \\", "plain"]
    _write_csv(src / "quoted.csv", HEADER, [line(t, account=str(i)) for i, t in enumerate(texts)])
    _write_csv(src / "doubled.csv", HEADER, [line('5" pipe, "big" one'), line("ends with \\")])
    (src / "latin.csv").write_bytes((",".join(HEADER) + "\n" + ",".join(line("café")) + "\n").encode("latin-1"))
    (src / "nothing.csv").write_bytes(b"")
    (src / "bom.csv").write_bytes(("﻿" + ",".join(HEADER) + "\r\n" + ",".join(line("bom")) + "\r\n").encode())
    rows, files = read_bills(spark, str(src))
    by_file = {}
    for r in rows.collect():
        by_file.setdefault(r.path.rsplit("/", 1)[-1], []).append((r.row_ord, r.charge_description, r.row_too_long))
    assert sorted(by_file["quoted.csv"]) == [(i + 1, t, False) for i, t in enumerate(texts)]
    assert sorted(by_file["doubled.csv"]) == [(1, '5" pipe, "big" one', False), (2, "ends with \\", False)]
    assert by_file["bom.csv"] == [(1, "bom", False)] and "latin.csv" not in by_file
    assert {r.path.rsplit("/", 1)[-1]: r.unreadable for r in files.collect()}["latin.csv"]
    _, got = run(spark, tmp_path, ["latin.csv", "nothing.csv", "bom.csv"])
    assert got == [("Error", fixed.MSG_NOT_AT_SOURCE)] * 2 + [("Success", "")]


def test_wide_header_keeps_every_name(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    n = 30_000
    header = [f"column with a rather long name of its own, number {i:06d}" for i in range(n)] + HEADER
    _write_csv(src / "wide.csv", header, [["x"] * n + line("wide")])
    assert (src / "wide.csv").stat().st_size > 1 << 20
    from ledgerline.sources.bills import file_profiles, header_positions
    profile = file_profiles(spark, str(src))
    assert profile.select(F.size("header"), F.element_at("header", -1)).first()[:] == (n + len(HEADER), "Units")
    found = header_positions(profile).first()
    assert found["_width"] == n + len(HEADER) and found["required_error"] is None and found["_pos_charge_amount"] == n + 3


def test_one_scan_whatever_the_number_of_files(spark, tmp_path):
    for i in range(30):
        header = HEADER if i % 2 else HEADER[::-1]
        cells = dict(zip(HEADER, line(f"d{i}"), strict=True))
        _write_csv(tmp_path / f"f {i}.csv", header, [[cells[h] for h in header]])
    rows, _ = read_bills(spark, str(tmp_path))
    assert sorted(r.charge_description for r in rows.collect()) == sorted(f"d{i}" for i in range(30))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "MapIn" not in plan and "BroadcastHashJoin" in plan


def test_money_units_and_keys(spark):
    df = spark.createDataFrame([("$ 10", " 2"), ("1_000", "x"), ("inf", None)], "c string, u string")
    value, bad = clean_money(F.col("c"))
    got = df.select(value.alias("v"), bad.alias("b"), units_number(floor_units(F.col("u"))).alias("n")).collect()
    assert [tuple(r) for r in got] == [(10.0, False, 2.0), (None, True, None), (None, True, None)]
    keys = {"a%20b%zz": "a b%zz", "1+2%2B": "1+2+", "%": "%", "%C3%A9%4": "é%4", "plain": "plain"}
    df = spark.createDataFrame(list(keys.items()), "k string, expected string")
    assert all(r.k2 == r.expected for r in df.select("expected", decode_key(F.col("k")).alias("k2")).collect())


def test_run_record_keeps_null_fields(spark):
    status = spark.createDataFrame([(0, "a", None, "", "Success")], "manifest_ord int, document_id string, extraction_date string, error string, status string")
    record = json.loads(run_record(status, JobParams()).first().run_record)
    assert record["files"] == [{"document_id": "a", "extraction_date": None, "error": "", "status": "Success"}]


def test_a_repeated_run_leaves_the_same_files(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write_csv(src / "DOC-1-aaaa-x.csv", HEADER, [line("a"), line("b")])
    kept = str(tmp_path / "decisions")
    first, got = run(spark, tmp_path, ["DOC-1-aaaa-x.csv"], decisions=kept)
    second, again = run(spark, tmp_path, ["DOC-1-aaaa-x.csv"], decisions=kept)
    assert got == again == [("Success", "")]
    assert sorted(r["_c3"] for r in sheet(spark, tmp_path, "DOC-1-aaaa-x")) == ["a", "b"]
    _, third = run(spark, tmp_path, ["DOC-1-aaaa-x.csv"])  # another run: the sheet is there
    assert third == [("Error", fixed.MSG_ALREADY_DONE)]


def test_a_replayed_batch_gives_the_same_status(spark, tmp_path):
    src, man, out = tmp_path / "src", tmp_path / "man", tmp_path / "status"
    src.mkdir()
    man.mkdir()
    _write_csv(src / "DOC-1-aaaa-x.csv", HEADER, [line("a")])
    files = [{"file_name": "DOC-1-aaaa-x.csv", "document_id": "aaaa", "original_file_name": "x", "display_id": "DOC-1"}]
    (man / "run1.json").write_text(json.dumps({"tenant_bridge_id": "t", "last_run_on_utc": None, "files": files}))
    for checkpoint in ("ck", "ck-lost"):  # a lost checkpoint: the same batch again
        start_incremental(spark, str(man), str(src), str(tmp_path / "dst"), str(out), str(tmp_path / checkpoint), JobParams(vendor="V")).awaitTermination()
    got = [(r.batch_id, r.document_id, r.status) for r in spark.read.parquet(str(out / "status")).collect()]
    assert got == [(0, "aaaa", "Success")]
    assert spark.read.json(str(out / "run_record")).count() == 1
