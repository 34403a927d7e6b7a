"""Registered queries: one per operator of the inventory, each over the
driver's tables (or data Spark derives from them), with DuckDB oracle SQL.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, oracle_sql | None)``.
A ``None`` oracle means a rows-only check (outputs that are files, JSON or
an order).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed
from ..functions import dates, money, text
from ..functions.describe import parse_charge_description
from ..functions.text import output_name
from ..operators import aggregates, contract, dedupe, filters, ordering, sheet, status
from ..params import JobParams
from ..session import drop_materialized, materialize, plan_settings, scratch_path, shuffles_removed
from ..sources import fixture, runlog
from ..sources.bills import decoded_path, read_bills
from ..sources.fixture import MANIFEST_SQL, OUTPUTS_SQL, billing_lines, with_billing_lines
from ..sources.manifest import read_manifest
from . import oracle as O
from .normalize import normalize_bills
from .run import existing_outputs, run_manifest

PARAMS = JobParams(client_name="Client", upload_user="loader", default_owner_email="")
Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    plan_settings(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _ts_text(c):
    return c.cast("string")


# ----------------------------------------------------------------------------------------
# Composed query (the flagship) and the fixture run
# ----------------------------------------------------------------------------------------

def flagship(spark: SparkSession, sf: str) -> DataFrame:
    joined = fixture.written_lines(spark, sf)
    rows = normalize_bills(billing_lines(spark, sf, joined), PARAMS, row_ord="row_id").rows
    drop_materialized(joined)  # the rows are lazy over the group table only
    return rows


register("normalize_bills", O.normalized_sql())(flagship)


def fixture_status(spark: SparkSession, sf: str) -> DataFrame:
    joined = fixture.written_lines(spark, sf)
    lines = billing_lines(spark, sf, joined)
    manifest = fixture.fixture_manifest(spark, sf)
    # written: it is read twice, and the lines' join is planned by its size (else all lines are shuffled by document first)
    m = materialize(status.manifest_status(manifest, fixture.fixture_sources(lines), fixture.fixture_outputs(spark, sf)), "decisions")
    todo = filters.eligible(m).select("document_id")
    lines_todo = lines.join(todo, "document_id", "left_semi")
    stats = normalize_bills(lines_todo, PARAMS, row_ord="row_id").doc_stats
    drop_materialized(joined)
    return status.document_status(m.select("manifest_ord", "document_id", "file_name", "error"), stats)


STATUS_COLS = "manifest_ord, document_id, file_name, extraction_date, error, status, error_kind, n_rows, n_kept"


@register("a6_status", O.status_sql(f"SELECT {STATUS_COLS} FROM status_final"))
def q_a6(spark, sf):
    return fixture_status(spark, sf).select(*[c.strip() for c in STATUS_COLS.split(",")])


@register("a2_counts", O.status_sql(
    "SELECT COUNT(*) AS files_in, COUNT(*) FILTER (WHERE status = 'Success') AS files_out, "
    "COUNT(*) FILTER (WHERE status = 'Error') AS files_error, CAST(COALESCE(SUM(n_rows), 0) AS BIGINT) AS rows_in "
    "FROM status_final"))
def q_a2(spark, sf):
    return status.run_counts(fixture_status(spark, sf))


@register("a3_error_log", O.status_sql(
    "SELECT manifest_ord AS log_ord, document_id, CASE WHEN error_kind = 'exception' "
    "THEN ' File=' || file_name || ', original=' || replace(file_name, '.csv', '') || '.xlsx, Error=' || error "
    "ELSE 'File=' || file_name || ', Error=' || error END AS log_entry "
    "FROM status_final WHERE error_kind IN ('rejected', 'exception')"))
def q_a3(spark, sf):
    return status.error_log(fixture_status(spark, sf))


@register("a5_empty_after", O.status_sql(
    "SELECT document_id, n_kept, (n_kept = 0) AS empty_after FROM doc_stats WHERE pre_error IS NULL"))
def q_a5(spark, sf):
    st = normalize_bills(billing_lines(spark, sf), PARAMS, row_ord="row_id").doc_stats
    return st.filter(F.col("pre_error").isNull()).select(
        "document_id", F.coalesce(F.col("n_kept"), F.lit(0)).cast("long").alias("n_kept"),
        (F.coalesce(F.col("n_kept"), F.lit(0)) == 0).alias("empty_after"))


@register("f3_eligible", with_billing_lines(f""",
manifest AS ({MANIFEST_SQL}), outputs AS ({OUTPUTS_SQL})
SELECT manifest_ord, document_id FROM manifest
WHERE document_id IN (SELECT document_id FROM billing_lines) AND document_id NOT IN (SELECT document_id FROM outputs)"""))
def q_f3(spark, sf):
    lines = billing_lines(spark, sf)
    m = status.manifest_status(fixture.fixture_manifest(spark, sf), fixture.fixture_sources(lines),
                               fixture.fixture_outputs(spark, sf))
    return filters.eligible(m).select("manifest_ord", "document_id")


@register("k2_run_record", O.status_sql(
    "SELECT '{\"files\":[' || string_agg('{\"document_id\":\"' || document_id || '\",\"extraction_date\":' || "
    "coalesce('\"' || extraction_date || '\"', 'null') || ',\"error\":\"' || error || '\",\"status\":\"' || status || '\"}', ',' "
    "ORDER BY manifest_ord) || '],\"tenant_bridge_id\":\"\",\"tenant_bridge_run_id\":\"\",\"summary\":\"EOF\"}' AS run_record FROM status_final"))
def q_k2(spark, sf):
    return status.run_record(fixture_status(spark, sf), PARAMS)


@register("o5_order", O.normalized_sql(
    "row_number() OVER (PARTITION BY document_id ORDER BY service_identifier ASC NULLS FIRST, "
    "piid_product ASC NULLS LAST, units_order ASC NULLS FIRST, row_id ASC) AS sheet_order, " + O.output_select_sql()))
def q_o5(spark, sf):
    return sheet.sheet_order(flagship(spark, sf))


def _k1_sql() -> str:
    """The sheet as a union: eight preamble rows for each document, then its rows, numbered, as text."""
    n = len(sheet.SHEET_NAMES)
    blank = ["' '"] * n
    line = lambda second=None: ["' '", second, *["' '"] * (n - 2)] if second else blank
    pre = [["''"] * n, line("'Service Upload Sheet'"), blank, line(f"'{PARAMS.client_name}'"),
           line(f"'User: {PARAMS.upload_user}'"), line("'01-Jan-2024 00:00:00'"), blank,
           [O.q(h) for h in PARAMS.sheet_headers()]]
    parts = [f"SELECT document_id, doc_label, CAST({k + 1} AS BIGINT) AS sheet_row, "
             + ", ".join(f"{c} AS _c{i}" for i, c in enumerate(cells)) + " FROM docs" for k, cells in enumerate(pre)]
    parts.append("SELECT document_id, doc_id AS doc_label, 8 + row_number() OVER (PARTITION BY document_id ORDER BY "
                 "service_identifier ASC NULLS FIRST, piid_parent ASC NULLS LAST, units_order ASC NULLS FIRST, row_ord ASC) AS sheet_row, "
                 + ", ".join(f"CAST({c} AS VARCHAR) AS _c{i}" for i, c in enumerate(sheet.SHEET_NAMES)) + " FROM rows_out")
    return with_billing_lines(f""", {O.stages_sql()},
rows_out AS (SELECT {O.output_select_sql()} FROM enriched WHERE pre_error IS NULL
  AND document_id NOT IN (SELECT document_id FROM doc_post WHERE post_error IS NOT NULL)),
docs AS (SELECT DISTINCT document_id, doc_id AS doc_label FROM rows_out)
{" UNION ALL ".join(parts)}""")


@register("k1_sheet", _k1_sql())
def q_k1(spark, sf):
    stamp = dates.stamp(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return sheet.upload_sheet(flagship(spark, sf), PARAMS, stamp)


@register("c5_project", O.normalized_sql("document_id, row_ord, " + ", ".join(sheet.SHEET_NAMES)).replace(
    "FROM enriched\n", f"FROM (SELECT {O.output_select_sql()}, pre_error FROM enriched)\n"))
def q_c5(spark, sf):
    return flagship(spark, sf).select("document_id", "row_ord", *sheet.SHEET_NAMES)


# ----------------------------------------------------------------------------------------
# Description parse, and one query per branch
# ----------------------------------------------------------------------------------------

P1_SQL = with_billing_lines(f""",
br AS (SELECT *, {O.branch_sql()} AS branch FROM billing_lines),
pp AS (SELECT row_id, document_id, branch, {O.parse_cols_sql()} FROM br)
SELECT row_id, document_id, branch AS description_branch, ident AS toll_free_number, pname AS product_name,
       perr AS description_error FROM pp""")


def _p1(spark, sf):
    return parse_charge_description(billing_lines(spark, sf)).select(
        "row_id", "document_id", "description_branch", "toll_free_number", "product_name", "description_error")


register("p1_parse", P1_SQL)(_p1)
for _b in "abcdefghi":
    def _p1b(spark, sf, _b=_b):
        return _p1(spark, sf).filter(F.col("description_branch") == _b)
    register(f"p1{_b}", P1_SQL + f"\nWHERE branch = '{_b}'")(_p1b)


# ----------------------------------------------------------------------------------------
# P2-P22 scalars
# ----------------------------------------------------------------------------------------

@register("p2_invoice_date", with_billing_lines(f"""
SELECT row_id, strftime({O.parse_ts('invoice_date')}, '%Y-%m-%d') AS invoice_date_norm,
  (invoice_date IS NOT NULL AND {O.parse_ts('invoice_date')} IS NULL) AS invoice_date_bad FROM billing_lines"""))
def q_p2(spark, sf):
    d = billing_lines(spark, sf).withColumn("_ts", dates.parse_timestamp(F.col("invoice_date")))
    return d.select("row_id", F.date_format("_ts", "yyyy-MM-dd").alias("invoice_date_norm"),
                    (F.col("invoice_date").isNotNull() & F.col("_ts").isNull()).alias("invoice_date_bad"))


@register("p2_infer_dates", with_billing_lines(f""",
dated AS ({fixture.DATED_LINES_SQL}), {O.inferred_dates_sql("dated")}
SELECT row_id, document_id, layout, strftime(ts, '%Y-%m-%d') AS invoice_date_norm,
  (invoice_date IS NOT NULL AND ts IS NULL) AS invoice_date_bad FROM dated_rows"""))
def q_p2_infer(spark, sf):
    """Documents whose dates have a layout each: the layout is found from the whole column."""
    lines = fixture.dated_lines(spark, sf)
    found = dates.inferred_layouts(lines, "document_id", "row_id", ["invoice_date"])
    names = F.array(*[F.lit(f) for f in fixed.INFERRED_FORMATS])
    d = lines.join(found, "document_id", "left").withColumn("_ts", dates.parse_by_layout(F.col("invoice_date"), F.col("invoice_date_layout")))
    return d.select("row_id", "document_id", F.get(names, F.col("invoice_date_layout")).alias("layout"), F.date_format("_ts", "yyyy-MM-dd").alias("invoice_date_norm"),
                    (F.col("invoice_date").isNotNull() & F.col("_ts").isNull()).alias("invoice_date_bad"))


@register("p3_key", with_billing_lines("""
SELECT row_id, COALESCE(billing_account_number, '') || COALESCE(service_id, '') || COALESCE(charge_description, '')
  AS business_key FROM billing_lines"""))
def q_p3(spark, sf):
    return billing_lines(spark, sf).select("row_id", text.business_key(
        F.col("billing_account_number"), F.col("service_id"), F.col("charge_description")).alias("business_key"))


@register("p4_sentinel", with_billing_lines(f""",
kept AS (SELECT * FROM billing_lines WHERE NOT COALESCE(charge_type IN {O.ONE_TIME}, FALSE)),
flag AS (SELECT document_id, bool_or(bill_to_date IS NOT NULL) AS has_bill_to FROM kept GROUP BY document_id)
SELECT k.row_id, f.has_bill_to,
  CAST(CASE WHEN k.bill_to_date IS NULL THEN CASE WHEN f.has_bill_to THEN TIMESTAMP '1900-01-01 00:00:00' END
       ELSE {O.parse_ts('k.bill_to_date')} END AS VARCHAR) AS bill_to_effective
FROM kept k JOIN flag f ON k.document_id = f.document_id"""))
def q_p4(spark, sf):
    kept = filters.drop_one_time(billing_lines(spark, sf))
    flag = dedupe.has_value_flag(kept, "document_id", "bill_to_date")
    j = kept.join(flag, "document_id")
    eff = dedupe.bill_to_for_frequency(dates.parse_timestamp(F.col("bill_to_date")), F.col("bill_to_date"),
                                       F.col("has_bill_to"))
    return j.select("row_id", "has_bill_to", _ts_text(eff).alias("bill_to_effective"))


@register("p5_money", with_billing_lines(f"""
SELECT row_id, {O.money_sql('charge_amount')} AS charge_value, {O.money_bad_sql('charge_amount')} AS charge_bad,
  {O.money_sql('discount_amount')} AS discount_value, {O.money_bad_sql('discount_amount')} AS discount_bad
FROM billing_lines"""))
def q_p5(spark, sf):
    d = money.with_money(billing_lines(spark, sf), "charge_amount", "charge_value")
    d = money.with_money(d, "discount_amount", "discount_value")
    return d.select("row_id", "charge_value", F.col("charge_value_bad").alias("charge_bad"),
                    "discount_value", F.col("discount_value_bad").alias("discount_bad"))


@register("p6_units_floor", with_billing_lines(f"SELECT row_id, {O.floor_units_sql('units')} AS units_floored FROM billing_lines"))
def q_p6(spark, sf):
    return money.with_units(billing_lines(spark, sf)).select("row_id", F.col("_u_floored").alias("units_floored"))


@register("p7_units_num", with_billing_lines(
    f"SELECT row_id, {O.units_num_sql(O.floor_units_sql('units'))} AS units_num FROM billing_lines"))
def q_p7(spark, sf):
    return money.with_units(billing_lines(spark, sf)).select("row_id", F.col("_u_num").alias("units_num"))


def _cost_frame(spark, sf):
    """Lines with charge, discount and units values as staged columns."""
    d = money.with_money(billing_lines(spark, sf), "charge_amount", "_charge")
    d = money.with_money(d, "discount_amount", "_discount")
    return money.with_units(d)


COST_SQL = f"""({O.money_sql('charge_amount')} - {O.money_sql('discount_amount')})"""
UNITS_SQL = O.units_num_sql(O.floor_units_sql("units"))


@register("p8_unit_cost", with_billing_lines(
    f"SELECT row_id, CASE WHEN {UNITS_SQL} = 0 THEN NULL ELSE {COST_SQL} / {UNITS_SQL} END AS unit_cost FROM billing_lines"))
def q_p8(spark, sf):
    d = _cost_frame(spark, sf)
    return d.select("row_id", money.unit_cost(F.col("_charge"), F.col("_discount"), F.col("_u_num")).alias("unit_cost"))


@register("p9_round3", with_billing_lines(
    f"SELECT row_id, {O.round3_sql(f'CASE WHEN {UNITS_SQL} = 0 THEN NULL ELSE {COST_SQL} / {UNITS_SQL} END')} "
    "AS unit_recurring_cost FROM billing_lines"))
def q_p9(spark, sf):
    d = _cost_frame(spark, sf)
    d = d.withColumn("_cost", money.unit_cost(F.col("_charge"), F.col("_discount"), F.col("_u_num")))
    return d.select("row_id", money.round3(F.col("_cost")).alias("unit_recurring_cost"))


@register("p10_quantity", with_billing_lines(f"SELECT row_id, {O.quantity_sql(UNITS_SQL)} AS service_quantity FROM billing_lines"))
def q_p10(spark, sf):
    d = money.with_units(billing_lines(spark, sf)).withColumn("_q", money.rounded_units(F.col("_u_num")))
    return d.select("row_id", money.quantity_from_rounded(F.col("_q")).alias("service_quantity"))


@register("p11_coerce_ts", with_billing_lines(
    f"SELECT row_id, CAST({O.parse_ts('bill_to_date')} AS VARCHAR) AS bill_to_ts, "
    f"CAST({O.parse_ts('bill_from_date')} AS VARCHAR) AS bill_from_ts FROM billing_lines"))
def q_p11(spark, sf):
    return billing_lines(spark, sf).select(
        "row_id", _ts_text(dates.parse_timestamp(F.col("bill_to_date"))).alias("bill_to_ts"),
        _ts_text(dates.parse_timestamp(F.col("bill_from_date"))).alias("bill_from_ts"))


def _dated(spark, sf):
    return billing_lines(spark, sf).withColumns({
        "_to": dates.parse_timestamp(F.col("bill_to_date")), "_from": dates.parse_timestamp(F.col("bill_from_date"))})


_DAYS_SQL = (f"floor(date_diff('microsecond', {O.parse_ts('bill_from_date')}, {O.parse_ts('bill_to_date')}) "
             "/ 86400000000.0)")


@register("p12_frequency", with_billing_lines(
    f"SELECT row_id, CAST({_DAYS_SQL} AS BIGINT) AS whole_days, round_even({_DAYS_SQL} / 30.0, 0) AS frequency_raw "
    "FROM billing_lines"))
def q_p12(spark, sf):
    return _dated(spark, sf).select(
        "row_id", dates.whole_days(F.col("_to"), F.col("_from")).cast("long").alias("whole_days"),
        dates.billing_frequency(F.col("_to"), F.col("_from")).alias("frequency_raw"))


@register("p13_clamp", with_billing_lines(
    f"SELECT row_id, {O.frequency_sql(O.parse_ts('bill_to_date'), O.parse_ts('bill_from_date'))} AS billing_frequency "
    "FROM billing_lines"))
def q_p13(spark, sf):
    d = _dated(spark, sf).withColumn("_freq", dates.billing_frequency(F.col("_to"), F.col("_from")))
    return d.select("row_id", dates.clamp_frequency(F.col("_freq")).alias("billing_frequency"))


@register("p14_currency", with_billing_lines("SELECT row_id, COALESCE(currency, 'USD') AS currency FROM billing_lines"))
def q_p14(spark, sf):
    return billing_lines(spark, sf).select("row_id", text.fill_currency(F.col("currency")).alias("currency"))


@register("p15_service_id", with_billing_lines(
    "SELECT row_id, COALESCE(service_id, '') AS service_identifier FROM billing_lines"))
def q_p15(spark, sf):
    return billing_lines(spark, sf).select("row_id", text.fill_blank(F.col("service_id")).alias("service_identifier"))


@register("p16_location_a", with_billing_lines(
    f"SELECT row_id, {O.location_a_sql('service_address_a', 'location_a_city', 'location_a_state', 'location_a_country')} "
    "AS location_a FROM billing_lines"))
def q_p16(spark, sf):
    return billing_lines(spark, sf).select("row_id", text.location_a(
        F.col("service_address_a"), F.col("location_a_city"), F.col("location_a_state"),
        F.col("location_a_country")).alias("location_a"))


# Location B over the A columns with more NULLs (address missing for one part size class).
_B_ADDR_SQL = "CASE WHEN location_a_city IS NULL AND location_a_state IS NULL THEN NULL ELSE service_address_a END"


@register("p17_location_b", with_billing_lines(
    f"SELECT row_id, {O.location_b_sql(_B_ADDR_SQL, 'location_a_city', 'location_a_state', 'NULL')} AS location_b "
    "FROM billing_lines"))
def q_p17(spark, sf):
    addr = F.when(F.col("location_a_city").isNull() & F.col("location_a_state").isNull(),
                  F.lit(None).cast("string")).otherwise(F.col("service_address_a"))
    return billing_lines(spark, sf).select("row_id", text.location_b(
        addr, F.col("location_a_city"), F.col("location_a_state"), F.lit(None).cast("string")).alias("location_b"))


@register("p18_doc_label", """
SELECT page_id, ('DOC-' || split_part(replace(replace(string_split('DOC-' || CAST(page_id % 97 AS VARCHAR) || '-'
  || replace(replace(url, '/', '_'), '-', '_') || '.csv', '/')[-1], '.csv', ''), 'DOC-', ''), '-', 1)) AS doc_label
FROM pages""")
def q_p18(spark, sf):
    pages = _t(spark, sf, "pages").select("page_id", "url")
    name = F.concat(F.lit("DOC-"), (F.col("page_id") % 97).cast("string"), F.lit("-"),
                    F.replace(F.replace(F.col("url"), F.lit("/"), F.lit("_")), F.lit("-"), F.lit("_")), F.lit(".csv"))
    return pages.select("page_id", text.doc_label(name).alias("doc_label"))


@register("p19_paths", """
SELECT page_id, string_split(url, '/')[-1] AS base_name, replace(string_split(url, '/')[-1], '.csv', '') AS stem,
  replace(string_split(url, '/')[-1], '.csv', '.xlsx') AS output_name FROM pages""")
def q_p19(spark, sf):
    b = text.base_name(F.col("url"))
    return _t(spark, sf, "pages").select("page_id", b.alias("base_name"), text.strip_ext(b).alias("stem"),
                                         text.swap_ext(b).alias("output_name"))


# Keys with good, bad and mixed escapes, and a plus sign; the SQL writes the decoded parts down.
_P20_PARTS = [("%20b", " b"), ("%zz", "%zz"), ("%C3%A9+x%2Fy", "é+x/y"), ("%", "%"), ("a%20b%zz%2B", "a b%zz+"), ("%4", "%4")]


@register("p20_decode", "SELECT page_id, CASE page_id % 6 " + " ".join(
    f"WHEN {k} THEN '{plain}'" for k, (_, plain) in enumerate(_P20_PARTS)) + " END || url AS decoded FROM pages")
def q_p20(spark, sf):
    pick = F.element_at(F.array(*[F.lit(e) for e, _ in _P20_PARTS]), (F.col("page_id") % 6 + 1).cast("int"))
    return _t(spark, sf, "pages").select("page_id", text.decode_key(F.concat(pick, F.col("url"))).alias("decoded"))


@register("p21_stamp", "SELECT event_id, strftime(ts, '%d-%b-%Y %H:%M:%S') AS stamp FROM events")
def q_p21(spark, sf):
    return _t(spark, sf, "events").select("event_id", dates.stamp(F.col("ts")).alias("stamp"))


@register("p22_flatten", """
SELECT doc_id, replace(replace(replace(replace(text, chr(10), ''), chr(13), ''), '\\n', ''), '\\r', '') AS flat_text
FROM documents""")
def q_p22(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", text.flatten_error(F.col("text")).alias("flat_text"))


# ----------------------------------------------------------------------------------------
# Filters, joins, windows, set operations, aggregates
# ----------------------------------------------------------------------------------------

@register("f1_recurring", with_billing_lines(
    f"SELECT row_id, charge_type FROM billing_lines WHERE NOT COALESCE(charge_type IN {O.ONE_TIME}, FALSE)"))
def q_f1(spark, sf):
    return filters.drop_one_time(billing_lines(spark, sf)).select("row_id", "charge_type")


_EXCL = "(" + ", ".join(O.q(v) for v in fixed.EXCLUDED_PRODUCT_LINES) + ")"


@register("f2_product_line", with_billing_lines(
    f"SELECT row_id, product_line FROM billing_lines WHERE NOT COALESCE(product_line IN {_EXCL}, FALSE)"))
def q_f2(spark, sf):
    return filters.exclude_product_lines(billing_lines(spark, sf)).select("row_id", "product_line")


@register("u1_union_all", with_billing_lines(
    f"SELECT row_id, product_line FROM billing_lines UNION ALL "
    f"SELECT row_id, product_line FROM billing_lines WHERE NOT COALESCE(product_line IN {_EXCL}, FALSE)"))
def q_u1(spark, sf):
    return sheet.append_filtered_copy(billing_lines(spark, sf).select("row_id", "product_line"))


@register("j1_source_exists", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def q_j1(spark, sf):
    return status.source_exists(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"),
                                _t(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


@register("j2_not_done", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def q_j2(spark, sf):
    return status.not_done(_t(spark, sf, "customer").select("c_custkey", "c_name"),
                           _t(spark, sf, "orders").filter("o_orderstatus = 'P'"), "c_custkey", "o_custkey")


@register("j2_run_log", """
WITH e AS (SELECT o_custkey, epoch_us(o_orderdate) + o_orderkey AS moment, o_orderstatus,
    CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS later FROM orders),
  n AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY moment DESC, later DESC) = 1)
SELECT c_custkey, coalesce(CASE n.o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'started' END, 'none') AS state
FROM customer LEFT JOIN n ON c_custkey = o_custkey WHERE n.o_orderstatus IS NULL OR n.o_orderstatus <> 'F'""")
def q_j2_log(spark, sf):
    """Orders as the log entries of earlier runs (finished: done, open: failed, else started), appended in three runs, compacted in
    between; customers whose newest entry isn't done, with its state."""
    root = scratch_path(spark, "run-log")
    orders = _t(spark, sf, "orders").withColumns({
        "output": F.col("o_custkey").cast("string"), "at": F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")})
    for k, (kind, state) in enumerate({"F": runlog.DONE, "O": runlog.FAILED, "P": runlog.STARTED}.items()):
        runlog.append(orders.filter(F.col("o_orderstatus") == kind), root, state, run_id=str(k), at=F.col("at"))
        if k == 1:
            runlog.compact(spark, root)
    customers = _t(spark, sf, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("output"))
    todo = status.not_done(customers, runlog.done_outputs(spark, root).withColumnRenamed("output", "done"), "output", "done")
    newest = runlog.latest(spark, root).select("output", "state")
    return todo.join(newest, "output", "left").select("c_custkey", F.coalesce("state", F.lit("none")).alias("state"))


@register("j3_prefix_match", """
WITH r AS (SELECT o_orderkey, 'DOC-' || CAST(o_orderkey % 100 AS VARCHAR) || '-' || CAST(o_custkey AS VARCHAR)
             || '-' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name FROM orders),
     m AS (SELECT CAST(c_custkey AS VARCHAR) AS document_id, c_custkey AS manifest_ord FROM customer),
     rb AS (SELECT *, replace(replace(file_name, '.csv', ''),
              'DOC-' || split_part(replace(replace(file_name, '.csv', ''), 'DOC-', ''), '-', 1) || '-', '') AS bare FROM r)
SELECT rb.o_orderkey, rb.file_name, arg_min(m.document_id, m.manifest_ord) AS matched_document_id
FROM rb LEFT JOIN m ON starts_with(rb.bare, m.document_id)
GROUP BY rb.o_orderkey, rb.file_name""")
def q_j3(spark, sf):
    o = _t(spark, sf, "orders")
    results = o.select("o_orderkey", F.concat(
        F.lit("DOC-"), (F.col("o_orderkey") % 100).cast("string"), F.lit("-"), F.col("o_custkey").cast("string"),
        F.lit("-"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"))
    manifest = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("document_id"),
                                                F.col("c_custkey").alias("manifest_ord"))
    return status.match_document(results, manifest)


@register("a1_extraction_date", with_billing_lines(f"""
SELECT document_id, first(strftime({O.parse_ts('invoice_date')}, '%Y-%m-%d') ORDER BY row_id) AS extraction_date
FROM billing_lines GROUP BY document_id"""))
def q_a1(spark, sf):
    d, _ = dates.normalize_invoice_date(F.col("invoice_date"))
    rows = billing_lines(spark, sf).withColumn("invoice_date_norm", d)
    return status.first_value(rows, "document_id", "invoice_date_norm", "row_id", "extraction_date")


# every input column but the two that make the key
_A4_COLS = [c for c in O.PRESENT_INPUT if c != "charge_description"]


@register("a4_first_per_key", with_billing_lines(
    "SELECT document_id, charge_description, "
    + ", ".join(f"arg_min({c}, row_id) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in _A4_COLS)
    + " FROM billing_lines GROUP BY document_id, charge_description"))
def q_a4(spark, sf):
    return aggregates.first_per_group(billing_lines(spark, sf), ["document_id", "charge_description"], "row_id", _A4_COLS)


@register("w1_latest", with_billing_lines(f"""
SELECT document_id, row_id, COALESCE(billing_account_number, '') || COALESCE(service_id, '')
  || COALESCE(charge_description, '') AS business_key, bill_to_date
FROM billing_lines WHERE NOT COALESCE(charge_type IN {O.ONE_TIME}, FALSE)
QUALIFY row_number() OVER (PARTITION BY document_id, business_key
  ORDER BY {O.parse_ts('bill_to_date')} DESC NULLS LAST, row_id DESC) = 1"""))
def q_w1(spark, sf):
    kept = filters.drop_one_time(billing_lines(spark, sf)).withColumn("business_key", text.business_key(
        F.col("billing_account_number"), F.col("service_id"), F.col("charge_description")))
    latest = dedupe.latest_per_key(kept, ["document_id", "business_key"], dedupe.bill_to_order(F.col("bill_to_date")),
                                   tie="row_id")
    return latest.select("document_id", "row_id", "business_key", "bill_to_date")


@register("w1_latest_events", """
SELECT user_id, event_id, CAST(ts AS VARCHAR) AS ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1""")
def q_w1e(spark, sf):
    ev = _t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    latest = dedupe.latest_per_key(ev, ["user_id"], F.col("ts"), tie="event_id")
    return latest.select("user_id", "event_id", _ts_text(F.col("ts")).alias("ts"), "event_type")


@register("o4_nulls_first", with_billing_lines(
    "SELECT row_id, service_id, row_number() OVER (ORDER BY service_id NULLS FIRST, row_id) AS position FROM billing_lines"))
def q_o4(spark, sf):
    return ordering.numbered_nulls_first(billing_lines(spark, sf).select("row_id", "service_id"), "service_id", "row_id")


# ----------------------------------------------------------------------------------------
# Row errors: the rejects of the composed job, and their summary for the status
# ----------------------------------------------------------------------------------------

_ERRORS_SQL = with_billing_lines(f""", {O.stages_sql()},
errors AS (SELECT document_id, row_id, unnest([
    CASE WHEN perr IS NOT NULL THEN perr END, CASE WHEN inv_bad THEN {O.q(fixed.ERR_INVOICE_DATE)} END,
    CASE WHEN {O.money_bad_sql('charge_amount')} THEN {O.q(fixed.ERR_CHARGE_AMOUNT)} END,
    CASE WHEN {O.money_bad_sql('discount_amount')} THEN {O.q(fixed.ERR_DISCOUNT_AMOUNT)} END]) AS code, unnest([1, 2, 3, 4]) AS stage FROM parsed)
""")


def _rejects(spark, sf):
    return normalize_bills(billing_lines(spark, sf), replace(PARAMS, keep_rejects=True), row_ord="row_id").rejects


@register("rejects", _ERRORS_SQL + "SELECT document_id, row_id AS row_ord, string_agg(code, ',' ORDER BY stage) AS errors FROM errors "
          "WHERE code IS NOT NULL GROUP BY document_id, row_id")
def q_rejects(spark, sf):
    return _rejects(spark, sf).withColumn("errors", F.array_join("errors", ","))


@register("a6_row_errors", _ERRORS_SQL + 'SELECT document_id, code, count(*) AS "rows", min(row_id) AS first_row FROM errors WHERE code IS NOT NULL GROUP BY document_id, code')
def q_row_errors(spark, sf):
    return status.row_error_summary(_rejects(spark, sf)).select("document_id", F.inline("row_errors"))


# ----------------------------------------------------------------------------------------
# Contract: C1-C4, C7, C8
# ----------------------------------------------------------------------------------------

# The fixture, and a row without any value for each of its documents.
@register("c1_drop_blank", with_billing_lines(
    "SELECT document_id, " + ", ".join(O.PRESENT_INPUT) + " FROM billing_lines WHERE COALESCE(" + ", ".join(O.PRESENT_INPUT) + ") IS NOT NULL"))
def q_c1(spark, sf):
    lines = billing_lines(spark, sf).select("document_id", *O.PRESENT_INPUT)
    nothing = lines.select("document_id", *[F.lit(None).cast("string").alias(c) for c in O.PRESENT_INPUT]).distinct()
    return contract.drop_blank_rows(lines.unionByName(nothing), O.PRESENT_INPUT)


@register("c3_empty", with_billing_lines(f""",
manifest AS ({MANIFEST_SQL}),
counts AS (SELECT document_id, COUNT(*) AS n_rows FROM billing_lines GROUP BY document_id)
SELECT m.manifest_ord, m.document_id, CAST(COALESCE(c.n_rows, 0) AS BIGINT) AS n_rows,
  CASE WHEN COALESCE(c.n_rows, 0) = 0 THEN {O.q(fixed.MSG_EMPTY_FILE)} END AS empty_error
FROM manifest m LEFT JOIN counts c ON m.document_id = c.document_id"""))
def q_c3(spark, sf):
    docs = fixture.fixture_manifest(spark, sf).select("manifest_ord", "document_id")
    out = contract.check_empty(docs, billing_lines(spark, sf))
    return out.select("manifest_ord", "document_id", F.col("n_rows").cast("long").alias("n_rows"), "empty_error")


@register("c4_optional", with_billing_lines(
    "SELECT row_id, " + ", ".join(f"'' AS {c}" for c in O.ABSENT_OPTIONAL) + ", currency FROM billing_lines"))
def q_c4(spark, sf):
    out = contract.add_optional(billing_lines(spark, sf))
    return out.select("row_id", *O.ABSENT_OPTIONAL, "currency")


@register("c7_drop", with_billing_lines("SELECT row_id, document_id, currency FROM billing_lines"))
def q_c7(spark, sf):
    return contract.drop_columns(billing_lines(spark, sf))


# The 40 output names over the input lines: those that the input has, else empty columns.
_C8_HAVE = {"account_identifier": "billing_account_number", "currency": "currency", "service_start_date": "bill_from_date",
            "service_identifier": "service_id", "location_a": "location_a_city", "piid_parent": "piid_product"}


@register("c8_sheet_columns", with_billing_lines("SELECT " + ", ".join(
    f"{_C8_HAVE[c]} AS {c}" if c in _C8_HAVE else f"CAST(NULL AS VARCHAR) AS {c}" for c in sheet.SHEET_NAMES)
    + ", row_id AS row_ord FROM billing_lines"))
def q_c8(spark, sf):
    d = billing_lines(spark, sf).withColumnsRenamed({v: k for k, v in _C8_HAVE.items()} | {"row_id": "row_ord"})
    return contract.project_columns(d, [*sheet.SHEET_NAMES, "row_ord"])


# ----------------------------------------------------------------------------------------
# Sources: S1 (CSV round trip of the fixture), C2 on its headers, S2, S3
# ----------------------------------------------------------------------------------------

# The fixture written as invoice CSV files, one folder per document, with the
# contract's header texts. DOC-3 is written without two required columns and in another order.
# Written as odd files, DOC-3 also has many columns of its own, and in DOC-2 a cell has a line break.
_DISPLAY = {v: k for k, v in fixed.CANONICAL_NAMES.items()}
_C2_DOC = "DOC-3"
_C2_DROPPED = ["charge_amount", "invoice_date"]
_BROKEN_DOC, _BROKEN_CELL, _BREAK = "DOC-2", "service_address_a", '\n"Floor", 2'


def write_fixture_csv(spark: SparkSession, sf: str, odd: bool = False) -> str:
    joined = fixture.written_lines(spark, sf)
    lines = billing_lines(spark, sf, joined)
    if odd:
        cell = F.col(_BROKEN_CELL)
        lines = lines.withColumn(_BROKEN_CELL, F.when(F.col("document_id") == _BROKEN_DOC, F.concat(cell, F.lit(_BREAK))).otherwise(cell))
    path = scratch_path(spark, "fixture-csv")
    cols = [c for c in lines.columns if c in _DISPLAY]
    keep = lines.filter(F.col("document_id") != _C2_DOC).select("document_id", *[F.col(c).alias(_DISPLAY[c]) for c in cols])
    keep.write.partitionBy("document_id").option("header", True).option("escape", '"').csv(path)
    short = [c for c in reversed(cols) if c not in _C2_DROPPED]
    lines.filter(F.col("document_id") == _C2_DOC).select(
        "document_id", *[F.lit("x").alias(f"Own column {i}") for i in range(80 if odd else 0)], *[F.col(c).alias(_DISPLAY[c]) for c in short]
    ).write.mode("append").partitionBy("document_id").option("header", True).option("escape", '"').csv(path)
    drop_materialized(joined)
    return path


def _doc_of_path(c):
    return F.regexp_extract(c, r"document_id=([^/]+)/", 1)


_S1_COLS = [c for c in fixed.CANONICAL_NAMES.values()]


def _s1_sql(odd: bool) -> str:
    def cell(c: str) -> str:
        if c not in O.PRESENT_INPUT:
            return f"'USD' AS {c}" if c == "currency" else f"'' AS {c}"
        if c in _C2_DROPPED:
            return f"CASE WHEN document_id = '{_C2_DOC}' THEN NULL ELSE NULLIF({c}, '') END AS {c}"
        if odd and c == _BROKEN_CELL:
            return f"CASE WHEN document_id = '{_BROKEN_DOC}' THEN {c} || chr(10) || {O.q(_BREAK[1:])} ELSE NULLIF({c}, '') END AS {c}"
        return f"NULLIF({c}, '') AS {c}"

    return with_billing_lines("SELECT document_id, " + ", ".join(map(cell, _S1_COLS)) + " FROM billing_lines")


@register("s1_scan_bills", _s1_sql(odd=False))
def q_s1(spark, sf):
    rows, _ = read_bills(spark, write_fixture_csv(spark, sf))
    return rows.select(_doc_of_path(F.col("path")).alias("document_id"), *_S1_COLS)


@register("s1_scan_odd_files", _s1_sql(odd=True))
def q_s1_odd(spark, sf):
    """The same with quoted line breaks in one document's files and wide ones of another."""
    rows, _ = read_bills(spark, write_fixture_csv(spark, sf, odd=True))
    return rows.select(_doc_of_path(F.col("path")).alias("document_id"), *_S1_COLS)


@register("c2_required", with_billing_lines(
    f"SELECT DISTINCT document_id, CASE WHEN document_id = '{_C2_DOC}' THEN "
    f"'Charge Amount, Invoice Date,  are missing.' END AS required_error FROM billing_lines"))
def q_c2(spark, sf):
    _, files = read_bills(spark, write_fixture_csv(spark, sf))
    return files.select(_doc_of_path(F.col("path")).alias("document_id"), "required_error").distinct()


@register("s2_manifest", """
SELECT 'T' || c_nationkey AS tenant_bridge_id, CAST(NULL AS VARCHAR) AS last_run_on_utc,
  CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS manifest_ord,
  'DOC-' || c_custkey || '-' || c_name || '.csv' AS file_name, CAST(c_custkey AS VARCHAR) AS document_id,
  c_name AS original_file_name, 'DOC-' || c_custkey AS display_id
FROM customer""")
def q_s2(spark, sf):
    """Manifest JSON documents written from `customer` (one manifest for each nation,
    JSON lines), read back and exploded."""
    cust = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch_path(spark, "manifest")
    rec = F.struct(
        F.concat(F.lit("DOC-"), F.col("c_custkey").cast("string"), F.lit("-"), F.col("c_name"), F.lit(".csv")).alias("file_name"),
        F.col("c_custkey").cast("string").alias("document_id"),
        F.col("c_name").alias("original_file_name"),
        F.concat(F.lit("DOC-"), F.col("c_custkey").cast("string")).alias("display_id"))
    docs = cust.groupBy("c_nationkey").agg(F.array_sort(F.collect_list(F.struct("c_custkey", rec.alias("rec")))).alias("recs"))
    docs = docs.select(F.concat(F.lit("T"), F.col("c_nationkey").cast("string")).alias("tenant_bridge_id"),
                       F.lit(None).cast("string").alias("last_run_on_utc"),
                       F.transform("recs", lambda x: x["rec"]).alias("files"))
    docs.write.json(path)
    return read_manifest(spark, path, multi_line=False)


@register("s3_outputs", "SELECT c_custkey || ' of nation ' || c_nationkey || ' (50%)' AS output FROM customer")
def q_s3(spark, sf):
    """Outputs written as the sheet sink writes them, one folder for each name, listed again. Making the folders is the
    work: they are dealt over tasks by name, however few the input has, by a number that isn't merged again for so few bytes."""
    path = scratch_path(spark, "outputs")
    name = F.concat(F.col("c_custkey").cast("string"), F.lit(" of nation "), F.col("c_nationkey").cast("string"), F.lit(" (50%)"))
    outputs = _t(spark, sf, "customer").select(name.alias("output"), "c_name")
    outputs.repartition(4 * spark.sparkContext.defaultParallelism, "output").write.partitionBy("output").csv(path)
    return existing_outputs(spark, path)


# ----------------------------------------------------------------------------------------
# The whole run over CSV files: manifest -> files -> sheets -> status
# ----------------------------------------------------------------------------------------

def _run_file(n) -> Column:
    """DOC-<n % 7>-<n> (carrier) a%20b.csv: spaces, parentheses and an escape in the
    name, and labels that two documents share."""
    num = F.regexp_extract(n, "([0-9]+)$", 1).cast("int")
    return F.concat(F.lit("DOC-"), (num % 7).cast("string"), F.lit("-"), num.cast("string"), F.lit(" (carrier) a%20b.csv"))


def write_run_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The fixture as one CSV file per document, and outputs of the documents already
    done. Each file also has a row without any value; a folder below the source holds files of
    the same names that the run must not read."""
    with shuffles_removed(spark):
        return _write_run_files(spark, sf)


def _write_run_files(spark: SparkSession, sf: str) -> tuple[str, str]:
    columns = fixture.line_columns()
    joined = fixture.written_lines(spark, sf)
    lines = joined.withColumn("document_id", columns["document_id"])
    src, parts, dst = (scratch_path(spark, n) for n in ("run-src", "run-parts", "run-dst"))
    # The tables' columns are shuffled and sorted, and made into the wider texts then.
    nothing = lines.select("document_id").distinct().withColumn("_nothing", F.lit(True))
    both = lines.withColumn("_nothing", F.lit(False)).unionByName(nothing, allowMissingColumns=True).repartition("document_id")
    both = both.sortWithinPartitions("document_id", F.when(F.col("_nothing"), "").otherwise(columns["row_id"]))
    both = both.select("document_id", *[F.when(~F.col("_nothing"), c.cast("string")).alias(_DISPLAY[n]) for n, c in columns.items() if n in _DISPLAY])
    both.write.partitionBy("document_id").option("header", True).option("escape", '"').csv(parts)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(parts).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path(src + "/old"))
    names = lines.select("document_id", _run_file(F.col("document_id")).alias("name")).distinct().collect()  # the fixture's 13 documents
    for k, r in enumerate(names):  # Spark names its files itself: give them the manifest's names
        made = [f.getPath() for f in fs.listStatus(hadoop_path(f"{parts}/document_id={r.document_id}"))]
        fs.rename(made[0], hadoop_path(src, r.name))
        if k:
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, hadoop_path(src, r.name), fs, hadoop_path(src + "/old", names[k - 1].name), False, fs.getConf())
    drop_materialized(joined)
    done = fixture.fixture_outputs(spark, sf).select(output_name(_run_file(F.col("document_id"))).alias("output"), F.lit("x").alias("x"))
    done.write.partitionBy("output").csv(dst)
    return src, dst


@register("run_csv", O.status_sql("""
SELECT s.manifest_ord, s.document_id,
  'DOC-' || (s.manifest_ord % 7) || '-' || s.manifest_ord || ' (carrier) a%20b.csv' AS file_name,
  extraction_date, regexp_replace(error, ' at row .*$', '') AS error, status, error_kind, n_rows, n_kept,
  CASE WHEN status = 'Success' THEN 8 + n_kept END AS sheet_rows,
  CASE WHEN status = 'Success' THEN 'DOC-' || (s.manifest_ord % 7) END AS sheet_label,
  CASE WHEN status = 'Success' THEN e.quantity END AS sheet_quantity
FROM status_final s LEFT JOIN (SELECT document_id, CAST(sum(service_quantity) AS BIGINT) AS quantity FROM enriched GROUP BY document_id) e
  ON s.document_id = e.document_id"""))
def q_run(spark, sf):
    """The job from files to files: its status, and what the sheets that it wrote hold."""
    src, dst = write_run_files(spark, sf)
    manifest = fixture.fixture_manifest(spark, sf).withColumn("file_name", _run_file(F.col("document_id")))
    status_rows = run_manifest(spark, manifest, src, dst, PARAMS).status
    cells = spark.read.schema(", ".join(f"_c{i} string" for i in range(len(sheet.SHEET_NAMES)))).option("escape", '"').csv(dst)
    at = {n: F.col(f"_c{i}") for i, n in enumerate(sheet.SHEET_NAMES)}
    cells = cells.withColumn("output", decoded_path(F.regexp_extract(decoded_path(F.col("_metadata.file_path")), "/output=([^/]+)/", 1)))
    data = at["vendor"] == PARAMS.vendor
    sheets = cells.groupBy("output").agg(
        F.count("*").alias("sheet_rows"), F.max(F.when(data, at["doc_id"])).alias("sheet_label"),
        F.sum(F.when(data, at["service_quantity"].try_cast("long"))).alias("sheet_quantity"))
    out = status_rows.withColumn("output", F.when(F.col("status") == fixed.STATUS_SUCCESS, output_name(F.col("file_name"))))
    return out.join(sheets, "output", "left").select(
        "manifest_ord", "document_id", "file_name", "extraction_date", F.regexp_replace("error", " at row .*$", "").alias("error"),
        "status", "error_kind", "n_rows", "n_kept", "sheet_rows", "sheet_label", "sheet_quantity")


# ----------------------------------------------------------------------------------------

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v[0] for k, v in Q.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in Q.items() if v[1] is not None}
