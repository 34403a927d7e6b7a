"""Incremental runs: each manifest dropped into the folder is run once."""

import json

from pyspark.sql import functions as F

from ledgerline.params import JobParams
from ledgerline.streaming.incremental import start_incremental
from test_job import _write_csv

HEADER = ["Billing Account Number", "Charge Description", "Charge Amount", "Discount Amount", "Invoice Date",
          "Bill From Date", "Bill To Date", "Units"]


def _manifest(path, names):
    files = [{"file_name": n, "document_id": n.split("-")[2], "original_file_name": n, "display_id": n[:5]} for n in names]
    path.write_text(json.dumps({"tenant_bridge_id": "t", "last_run_on_utc": None, "files": files}))


def test_each_manifest_runs_once(spark, tmp_path):
    src, dst, man, out = tmp_path / "src", tmp_path / "dst", tmp_path / "man", tmp_path / "status"
    src.mkdir()
    man.mkdir()
    row = ["1", "Plain", "10", "0", "2023-01-17", "2023-01-01", "2023-01-31", "2"]
    _write_csv(src / "DOC-1-aaaa-x.csv", HEADER, [row])
    _write_csv(src / "DOC-2-bbbb-y.csv", HEADER, [row])
    params = JobParams(vendor="V")
    ck = str(tmp_path / "ck")
    _manifest(man / "run1.json", ["DOC-1-aaaa-x.csv"])
    start_incremental(spark, str(man), str(src), str(dst), str(out), ck, params).awaitTermination()
    _manifest(man / "run2.json", ["DOC-1-aaaa-x.csv", "DOC-2-bbbb-y.csv"])
    start_incremental(spark, str(man), str(src), str(dst), str(out), ck, params).awaitTermination()
    st = spark.read.parquet(str(out / "status"))
    got = sorted((r.batch_id, r.document_id, r.status) for r in st.collect())
    assert got == [(0, "aaaa", "Success"), (1, "aaaa", "Error"), (1, "bbbb", "Success")]
    assert st.filter(F.col("error").contains("already exists")).count() == 1
