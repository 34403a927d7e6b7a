"""What earlier runs completed: the log, half-written sheets, runs in groups; row errors
and inferred date layouts of a whole run."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import base_row, lines_df
from ledgerline import fixed
from ledgerline.functions import dates
from ledgerline.operators.status import row_error_summary
from ledgerline.params import JobParams
from ledgerline.plans.normalize import normalize_bills
from ledgerline.plans.run import adopt_outputs, file_groups, incomplete_outputs, run_manifest
from ledgerline.sources import runlog
from test_csv_run import HEADER, line, run, sheet
from test_job import _write_csv

OK, DONE = ("Success", ""), ("Error", fixed.MSG_ALREADY_DONE)


def entry(spark, *outputs):
    return spark.createDataFrame([(o, f"id-{o}") for o in outputs], "output string, document_id string")


def done(spark, root):
    return {r.output for r in runlog.done_outputs(spark, root).collect()}


def test_the_newest_entry_holds_before_and_after_compaction(spark, tmp_path):
    root = str(tmp_path / "log")
    assert done(spark, root) == set()
    runlog.append(entry(spark, "a", "b", "c", "d"), root, runlog.STARTED, "r1", at=10)
    runlog.append(entry(spark, "a", "b"), root, runlog.DONE, "r1", at=20)
    runlog.append(entry(spark, "c"), root, runlog.FAILED, "r1", at=20)
    assert done(spark, root) == {"a", "b"}
    runlog.append(entry(spark, "b"), root, runlog.STARTED, "r2", at=30)  # written over, and never finished
    runlog.append(entry(spark, "c"), root, runlog.STARTED, "r2", at=30)
    runlog.append(entry(spark, "c"), root, runlog.DONE, "r2", at=30)  # the same moment: the later state
    before = sorted(map(tuple, runlog.latest(spark, root).collect()))
    assert done(spark, root) == {"a", "c"} and [(r[0], r[2]) for r in before] == [("a", "done"), ("b", "started"), ("c", "done"), ("d", "started")]
    runlog.compact(spark, root)
    assert sorted(map(tuple, runlog.latest(spark, root).collect())) == before
    assert runlog.entries(spark, root).select("entry").distinct().count() == 1
    runlog.append(entry(spark, "d"), root, runlog.DONE, "r3", at=5)  # older than what is there
    assert done(spark, root) == {"a", "c"}


def test_a_half_written_sheet_is_written_again(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    names = [f"DOC-{i}-x.csv" for i in range(3)]
    for n in names:
        _write_csv(src / n, HEADER, [line("a"), line("b\nwith a break"), line("c")])
    _, got = run(spark, tmp_path, names[:2])
    assert got == [OK, OK] and incomplete_outputs(spark, str(tmp_path / "dst")).count() == 0
    log = runlog.log_root(str(tmp_path / "dst"))
    assert {(r.output, r.state, r.sheet_rows) for r in runlog.latest(spark, log).collect()} == {("DOC-0-x", "done", 11), ("DOC-1-x", "done", 11)}
    # a run that dies while its files are moved: a part of the sheet is there, and no entry says that it is done
    runlog.append(entry(spark, "DOC-1-x"), log, runlog.STARTED)
    folder = tmp_path / "dst" / "output=DOC-1-x"
    parts = sorted(p for p in folder.iterdir() if p.suffix == ".csv")
    parts[0].write_text("")
    _, got = run(spark, tmp_path, names)
    assert got == [DONE, OK, OK]
    assert sorted(r["_c3"] for r in sheet(spark, tmp_path, "DOC-0-x"))[0] == "a"
    assert incomplete_outputs(spark, str(tmp_path / "dst")).count() == 0
    for p in (q for q in (tmp_path / "dst" / "output=DOC-2-x").iterdir() if q.suffix == ".csv"):  # lost after it was done
        p.write_text("")
    assert [r.output for r in incomplete_outputs(spark, str(tmp_path / "dst")).collect()] == ["DOC-2-x"]


def test_sheets_without_a_log_are_adopted(spark, tmp_path):
    src, dst = tmp_path / "src", tmp_path / "dst"
    src.mkdir()
    for n in ("DOC-1-x.csv", "DOC-2-x.csv"):
        _write_csv(src / n, HEADER, [line("a")])
    spark.createDataFrame([("DOC-1-x", "v")], "output string, c string").write.partitionBy("output").csv(str(dst))
    _, got = run(spark, tmp_path, ["DOC-1-x.csv", "DOC-2-x.csv"])  # the first run with a log
    assert got == [DONE, OK]
    spark.createDataFrame([("DOC-3-x", "v")], "output string, c string").write.mode("append").partitionBy("output").csv(str(dst))
    assert done(spark, runlog.log_root(str(dst))) == {"DOC-1-x", "DOC-2-x"}  # not listed again
    adopt_outputs(spark, str(dst))
    assert done(spark, runlog.log_root(str(dst))) == {"DOC-1-x", "DOC-2-x", "DOC-3-x"}
    adopt_outputs(spark, str(dst))  # known by now
    assert runlog.latest(spark, runlog.log_root(str(dst))).filter("sheet_rows is null").count() == 2
    assert incomplete_outputs(spark, str(dst)).count() == 0


def test_a_failed_document_is_tried_again(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write_csv(src / "DOC-1-x.csv", HEADER, [line("a", charge="on request")])
    _, got = run(spark, tmp_path, ["DOC-1-x.csv"])
    assert got[0][1].startswith(fixed.ERR_CHARGE_AMOUNT)
    assert [r.state for r in runlog.latest(spark, runlog.log_root(str(tmp_path / "dst"))).collect()] == ["failed"]
    _write_csv(src / "DOC-1-x.csv", HEADER, [line("a")])
    assert run(spark, tmp_path, ["DOC-1-x.csv"])[1] == [OK]
    assert run(spark, tmp_path, ["DOC-1-x.csv"])[1] == [DONE]


def test_a_run_in_groups_equals_a_run_in_one(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    names = [f"DOC-{i}-x.csv" for i in range(9)] + ["gone.csv", "bad.csv"]
    for i, n in enumerate(names[:9]):
        _write_csv(src / n, HEADER if i % 2 else HEADER[:-1], [line(f"d{k}", account=str(k))[: len(HEADER) - 1 + i % 2] for k in range(i + 1)])
    _write_csv(src / "bad.csv", HEADER[1:], [line("a")[1:]])
    manifest = spark.createDataFrame([(i, n, f"id{i}") for i, n in enumerate(names)], "manifest_ord int, file_name string, document_id string")
    found = []
    for k, params in enumerate((JobParams(vendor="V"), JobParams(vendor="V", group_files=3), JobParams(vendor="V", group_bytes=500))):
        dst = str(tmp_path / f"dst{k}")
        res = run_manifest(spark, manifest, str(src), dst, params, run_ts=F.lit("2024-01-01").cast("timestamp_ntz"))
        cells = spark.read.option("escape", '"').csv(dst)
        found.append((sorted(map(tuple, res.status.collect()), key=repr), sorted(map(tuple, cells.collect()), key=repr), res.normalized.count(), res.record.first()[0]))
    assert found[0] == found[1] == found[2] and len(found[0][0]) == len(names)
    todo = spark.createDataFrame([(f"o{i}", 10) for i in range(1000)] + [("huge", 10**9)], "output string, size long")
    grouped, n = file_groups(todo, 100, 10**6)
    sizes = [r["count"] for r in grouped.groupBy("_group").count().collect()]
    assert n == 11 and max(sizes) < 200
    assert file_groups(todo, 100_000, 1000)[1] == 11  # a file counts as one group's bytes at most


# --- rejects


def test_every_error_of_every_row(spark):
    rows = [
        base_row(charge_description="ok", row_ord=1), base_row(charge_description=None, invoice_date="soon", charge_amount="x", row_ord=2),
        base_row(charge_description="ok", discount_amount="10%", bill_to_date="2020-01-01", row_ord=3),  # not the latest of its key
        base_row(charge_description="Business White Pages Listing none", row_ord=4), base_row(document_id="DOC-2", row_ord=1),
    ]
    kept, plain = (normalize_bills(lines_df(spark, rows), JobParams(keep_rejects=k)) for k in (True, False))
    assert plain.rejects is None
    got = {(r.document_id, r.row_ord): r.errors for r in kept.rejects.collect()}
    assert got == {
        ("DOC-1", 2): [fixed.ERR_DESCRIPTION_MISSING, fixed.ERR_INVOICE_DATE, fixed.ERR_CHARGE_AMOUNT],
        ("DOC-1", 3): [fixed.ERR_DISCOUNT_AMOUNT], ("DOC-1", 4): [fixed.ERR_LISTING_WITHOUT_DASH],
    }
    for a, b in ((kept.rows, plain.rows), (kept.doc_stats, plain.doc_stats)):  # the copies change nothing else
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    summary = {r.document_id: [tuple(e) for e in r.row_errors] for r in row_error_summary(kept.rejects).collect()}
    assert summary["DOC-1"] == sorted([(fixed.ERR_DESCRIPTION_MISSING, 1, 2), (fixed.ERR_INVOICE_DATE, 1, 2), (fixed.ERR_CHARGE_AMOUNT, 1, 2),
                                       (fixed.ERR_DISCOUNT_AMOUNT, 1, 3), (fixed.ERR_LISTING_WITHOUT_DASH, 1, 4)])


def test_a_run_keeps_rejects(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    _write_csv(src / "a.csv", HEADER, [line("a"), line("b", charge="x"), line("c") + ["more"]])
    manifest = spark.createDataFrame([(0, "a.csv", "id0")], "manifest_ord int, file_name string, document_id string")
    res = run_manifest(spark, manifest, str(src), str(tmp_path / "dst"), JobParams(vendor="V", keep_rejects=True))
    assert sorted((r.document_id, r.row_ord, r.errors) for r in res.rejects.collect()) == [("id0", 2, [fixed.ERR_CHARGE_AMOUNT]), ("id0", 3, [fixed.ERR_ROW_TOO_LONG])]


# --- layouts


def brute_layout(texts, formats):
    """The first layout that fits all texts, else the first text's first."""
    def fits(text, fmt):
        letters = {"yyyy": "%Y", "MMM": "%b", "MM": "%m", "dd": "%d", "mm": "%M", "ss": "%S", "M": "%m", "d": "%d", "H": "%H"}
        import re

        if not re.match(dates.layout_shape(fmt), text):
            return None
        try:
            return datetime.strptime(text, "".join(letters.get(p, p.strip("'")) for p in re.split("('[^']*'|y+|M+|d+|H+|m+|s+)", fmt)))
        except ValueError:
            return None

    every = [k for k, f in enumerate(formats) if all(fits(t, f) for t in texts)]
    first = [k for k, f in enumerate(formats) if fits(texts[0], f)]
    k = (every or first or [None])[0]
    return k, [fits(t, formats[k]) if k is not None else None for t in texts]


def test_layouts_equal_trying_all(spark):
    rng = random.Random(4)
    writers = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%b-%Y", "%Y%m%d", "%b %d, %Y", "%d.%m.%Y", "%Y-%m-%dT%H:%M:%S", "%m-%d-%Y", "%Y/%m/%d", "%m/%d/%Y %H:%M"]
    documents = {}
    for n in range(60):
        some = rng.sample(writers, rng.choice([1, 1, 1, 2]))  # a fourth of them mixed
        days = [datetime(2024, 1, 1, 5, 7) + timedelta(days=rng.randint(0, rng.choice([11, 400]))) for _ in range(rng.randint(1, 6))]
        documents[f"D{n}"] = [d.strftime(rng.choice(some)) for d in days] + rng.choice([[], [], ["soon"], ["2024-02-31"]])
    documents["ambiguous"] = ["03/04/2024", "05/06/2024"]
    documents["day first"] = ["03/04/2024", "25/06/2024"]
    documents["none"] = ["soon", "later"]
    rows = [(d, i, t, None) for d, texts in documents.items() for i, t in enumerate(texts)] + [("missing", 0, None, None)]
    df = spark.createDataFrame(rows, "document_id string, row_ord int, invoice_date string, bill_to_date string")
    found = dates.inferred_layouts(df, "document_id", "row_ord", ["invoice_date", "bill_to_date"])
    read = df.join(found, "document_id", "left").withColumn("ts", dates.parse_by_layout(F.col("invoice_date"), F.col("invoice_date_layout"))).collect()
    formats = fixed.INFERRED_FORMATS
    for d, texts in documents.items():
        k, values = brute_layout(texts, formats)
        mine = sorted((r for r in read if r.document_id == d), key=lambda r: r.row_ord)
        assert {r.invoice_date_layout for r in mine} == {k} and [r.ts for r in mine] == values, d
        assert {r.bill_to_date_layout for r in mine} == {None}
    by = {r.document_id: r.invoice_date_layout for r in read}
    assert formats[by["ambiguous"]] == "M/d/yyyy" and formats[by["day first"]] == "d/M/yyyy" and by["none"] is None and by["missing"] is None


@pytest.mark.parametrize("writer", ["%d/%m/%Y", "%d-%b-%Y", "%Y%m%d", "%b %d, %Y"])
def test_a_document_in_another_layout_equals_the_iso_one(spark, writer):
    def rows(fmt):
        day = lambda text: datetime.strptime(text, "%Y-%m-%d").strftime(fmt)
        made = [("1", "2023-01-17", "2023-01-01", "2023-01-31"), ("1", "2023-01-18", "2023-02-01", "2023-03-31"), ("2", "2023-01-19", "2023-01-01", "2023-12-31")]
        return [base_row(service_id=s, invoice_date=day(i), bill_from_date=day(a), bill_to_date=day(b), row_ord=k) for k, (s, i, a, b) in enumerate(made)]

    params = JobParams(date_mode="infer")
    got, iso = (normalize_bills(lines_df(spark, rows(f)), params) for f in (writer, "%Y-%m-%d"))
    names = ["document_id", "service_identifier", "billing_frequency", "extraction_date", "row_ord"]
    assert sorted(map(tuple, got.rows.select(*names).collect())) == sorted(map(tuple, iso.rows.select(*names).collect())) and got.rows.count() == 2
    plain = normalize_bills(lines_df(spark, rows("%Y-%m-%d")), JobParams()).rows.select(*names)
    assert sorted(map(tuple, iso.rows.select(*names).collect())) == sorted(map(tuple, plain.collect()))
    with pytest.raises(ValueError):
        normalize_bills(lines_df(spark, rows(writer)), JobParams(date_mode="guess"))
