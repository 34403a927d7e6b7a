"""DuckDB oracle SQL for the registered queries.

Written from the operator semantics directly (Python ``split``/``join`` as
DuckDB ``string_split`` + list slices, numpy rounding as ``round_even``), not
from the Spark expressions, so the two sides check each other.
"""

from __future__ import annotations

import re

from .. import fixed
from ..functions.dates import layout_shape
from ..sources.fixture import MANIFEST_SQL, OUTPUTS_SQL, with_billing_lines


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
ABSENT_OPTIONAL = [
    "service_number", "bill_invoice_number", "account_description_1", "bus_org_id", "internal_account_number",
    "legacy_circuit_id", "product_family", "install_date", "carrier_circuit_id", "service_line",
    "service_address_b", "location_z_city", "location_z_state", "location_z_country",
]
PRESENT_INPUT = [
    "billing_account_number", "service_id", "charge_description", "charge_type", "product_line", "piid_product",
    "charge_amount", "discount_amount", "units", "currency", "service_address_a", "location_a_city",
    "location_a_state", "location_a_country", "invoice_date", "bill_from_date", "bill_to_date",
]


def parse_ts(expr: str) -> str:
    fmts = ["%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%m/%d/%Y", "%m/%d/%Y %H:%M"]
    return "COALESCE(" + ", ".join(f"try_strptime({expr}, {q(f)})" for f in fmts) + ")"


def layout_sql(fmt: str) -> str:
    """DuckDB's letters for one of the inferred layouts."""
    letters = {"yyyy": "%Y", "MMM": "%b", "MM": "%m", "dd": "%d", "M": "%m", "d": "%d", "H": "%H", "mm": "%M", "ss": "%S"}
    return "".join(letters.get(p, p.strip("'")) for p in re.split("('[^']*'|y+|M+|d+|H+|m+|s+)", fmt))


def inferred_dates_sql(table: str) -> str:
    """For each row of ``table`` (row_id, document_id, invoice_date) the layout of its document's column and the date read by it."""
    fits = [f"(regexp_full_match(invoice_date, {q(layout_shape(f)[1:-1])}) AND try_strptime(invoice_date, {q(layout_sql(f))}) IS NOT NULL)" for f in fixed.INFERRED_FORMATS]
    every = [f"bool_and({f}) AS all{k}, arg_min({f}, row_id) AS one{k}" for k, f in enumerate(fits)]
    number = lambda kind: " ".join(f"WHEN {kind}{k} THEN {k}" for k in range(len(fits)))
    read = " ".join(f"WHEN {k} THEN CASE WHEN {f} THEN try_strptime(invoice_date, {q(layout_sql(fixed.INFERRED_FORMATS[k]))}) END" for k, f in enumerate(fits))
    name = " ".join(f"WHEN {k} THEN {q(f)}" for k, f in enumerate(fixed.INFERRED_FORMATS))
    return f"""found AS (SELECT document_id, {", ".join(every)} FROM {table} WHERE invoice_date IS NOT NULL GROUP BY document_id),
layouts AS (SELECT document_id, CASE {number("all")} {number("one")} END AS layout FROM found),
dated_rows AS (SELECT t.row_id, t.document_id, t.invoice_date, CASE l.layout {name} END AS layout, CASE l.layout {read} END AS ts
  FROM {table} t LEFT JOIN layouts l ON t.document_id = l.document_id)"""


def branch_sql(s: str = "charge_description") -> str:
    c = lambda m: f"contains({s}, {q(m)})"
    return (
        f"CASE WHEN {s} IS NULL THEN NULL "
        f"WHEN {c(fixed.MARK_CUSTOMER_REF)} AND {c(fixed.MARK_CIRCUIT)} THEN 'a' "
        f"WHEN {c(fixed.MARK_CUSTOMER_REF)} THEN 'b' WHEN {c(fixed.MARK_CIRCUIT)} THEN 'c' "
        f"WHEN {c(fixed.MARK_CIRCUIT_SPACED)} THEN 'd' WHEN {c(fixed.MARK_TOLL_FREE_SPACED)} THEN 'e' "
        f"WHEN {c(fixed.MARK_TOLL_FREE)} THEN 'f' WHEN {c(fixed.MARK_TN_FEE)} THEN 'g' "
        f"WHEN {c(fixed.MARK_WHITE_PAGES)} THEN 'h' ELSE 'i' END"
    )


def _rest(t: str, sep: str) -> str:
    """' '.join(t.split(sep)[1:])"""
    return f"array_to_string(string_split({t}, {q(sep)})[2:], ' ')"


def parse_cols_sql(s: str = "charge_description", br: str = "branch") -> str:
    """ident, pname, perr from the branch, following str.split semantics."""
    cri, ckt = q(fixed.MARK_CUSTOMER_REF), q(fixed.MARK_CIRCUIT)
    t_cri = f"split_part({s}, {cri}, 2)"
    h_cri = f"split_part({s}, {cri}, 1)"

    def tail(m: str) -> str:
        return f"split_part({s}, {q(m)}, 2)"

    def head(m: str) -> str:
        return f"split_part({s}, {q(m)}, 1)"

    ident = (
        f"CASE {br} "
        f"WHEN 'a' THEN string_split({t_cri}, '-')[1] || ' ' || split_part({h_cri}, {ckt}, 2) "
        f"WHEN 'b' THEN string_split({t_cri}, '-')[1] "
        f"WHEN 'c' THEN string_split({tail(fixed.MARK_CIRCUIT)}, ' ')[1] "
        f"WHEN 'd' THEN string_split({tail(fixed.MARK_CIRCUIT_SPACED)}, ' ')[1] "
        f"WHEN 'e' THEN string_split({tail(fixed.MARK_TOLL_FREE_SPACED)}, '-')[1] "
        f"WHEN 'f' THEN string_split({tail(fixed.MARK_TOLL_FREE)}, '-')[1] "
        f"WHEN 'g' THEN string_split({s}, '-')[2] "
        f"WHEN 'h' THEN string_split({s}, '-')[2] "
        f"WHEN 'i' THEN '' END"
    )
    pname = (
        f"CASE {br} "
        f"WHEN 'a' THEN split_part({h_cri}, {ckt}, 1) || ' ' || {_rest(t_cri, '-')} "
        f"WHEN 'b' THEN {h_cri} || ' ' || {_rest(t_cri, '-')} "
        f"WHEN 'c' THEN {head(fixed.MARK_CIRCUIT)} || ' ' || {_rest(tail(fixed.MARK_CIRCUIT), ' ')} "
        f"WHEN 'd' THEN {head(fixed.MARK_CIRCUIT_SPACED)} || ' ' || {_rest(tail(fixed.MARK_CIRCUIT_SPACED), ' ')} "
        f"WHEN 'e' THEN {head(fixed.MARK_TOLL_FREE_SPACED)} || ' ' || {_rest(tail(fixed.MARK_TOLL_FREE_SPACED), '-')} "
        f"WHEN 'f' THEN {head(fixed.MARK_TOLL_FREE)} || ' ' || {_rest(tail(fixed.MARK_TOLL_FREE), '-')} "
        f"WHEN 'g' THEN string_split({s}, '-')[1] "
        f"WHEN 'h' THEN string_split({s}, '-')[1] "
        f"WHEN 'i' THEN {s} END"
    )
    perr = (
        f"CASE WHEN {s} IS NULL THEN {q(fixed.ERR_DESCRIPTION_MISSING)} "
        f"WHEN {br} = 'a' AND NOT contains({h_cri}, {ckt}) THEN {q(fixed.ERR_MARKER_ORDER)} "
        f"WHEN {br} = 'h' AND NOT contains({s}, '-') THEN {q(fixed.ERR_LISTING_WITHOUT_DASH)} END"
    )
    return (f"CASE WHEN ({perr}) IS NULL THEN {ident} END AS ident, "
            f"CASE WHEN ({perr}) IS NULL THEN {pname} END AS pname, {perr} AS perr")


def money_sql(c: str) -> str:
    cleaned = f"regexp_replace({c}, '[\\s\\x{{00A0}}$(),]', '', 'g')"
    return f"CASE WHEN regexp_full_match({cleaned}, {q(NUM)}) THEN TRY_CAST({cleaned} AS DOUBLE) END"


def money_bad_sql(c: str) -> str:
    cleaned = f"regexp_replace({c}, '[\\s\\x{{00A0}}$(),]', '', 'g')"
    return f"({c} IS NOT NULL AND NOT regexp_full_match({cleaned}, {q(NUM)}))"


def units_text_sql(u: str) -> str:
    t = f"trim({u})"
    canon = f"regexp_replace(regexp_replace({t}, '^\\+', ''), '^(-?)0+(\\d)', '\\1\\2')"
    return f"(CASE WHEN regexp_full_match({t}, {q(NUM)}) THEN {canon} ELSE {u} END)"


def floor_units_sql(u: str) -> str:
    t = f"COALESCE({units_text_sql(u)}, 'nan')"
    return f"(CASE WHEN {t} < '1' THEN '1.00' ELSE {t} END)"


def units_num_sql(floored: str) -> str:
    r = f"regexp_replace({floored}, '[-\\s\\x{{00A0}};,:_()\\/]', '', 'g')"
    return f"(CASE WHEN regexp_full_match({r}, {q(NUM)}) THEN TRY_CAST({r} AS DOUBLE) END)"


def round3_sql(x: str) -> str:
    return f"COALESCE(round_even(({x}) * 1000.0, 0) / 1000.0, 0.0)"


def quantity_sql(u: str) -> str:
    qq = f"CAST(round_even(COALESCE({u}, 0.0), 0) AS BIGINT)"
    return f"(CASE WHEN {qq} = 0 THEN CAST(1 AS BIGINT) ELSE {qq} END)"


def frequency_sql(to_ts: str, from_ts: str) -> str:
    days = f"floor(date_diff('microsecond', {from_ts}, {to_ts}) / 86400000000.0)"
    f = f"round_even({days} / 30.0, 0)"
    return f"(CASE WHEN {f} <= 0.9 THEN 1.0 ELSE {f} END)"


def location_a_sql(a: str, city: str, st: str, ctry: str) -> str:
    return f"({a} || ' ' || {city} || ' ' || COALESCE({st}, '') || ' ' || {ctry})"


def location_b_sql(a: str, city: str, st: str, ctry: str, tok: str = "nan") -> str:
    j = " || ' ' || ".join(f"COALESCE({c}, {q(tok)})" for c in (a, city, st, ctry))
    return f"(CASE WHEN ({j}) = {q(' '.join([tok] * 4))} THEN '' ELSE ({j}) END)"


def doc_label_sql(name: str) -> str:
    base = f"replace(string_split({name}, '/')[-1], '.csv', '')"
    return f"('DOC-' || split_part(replace({base}, 'DOC-', ''), '-', 1))"


ONE_TIME = "(" + ", ".join(q(v) for v in fixed.ONE_TIME_CHARGE_TYPES) + ")"


def stages_sql(vendor: str = "Carrier") -> str:
    """CTE chain over billing_lines that ends in `enriched` (rows after W1 with
    every output value), `doc_pre` and `doc_post`."""
    absent = ", ".join(f"'' AS {c}" for c in ABSENT_OPTIONAL)
    not_blank = "COALESCE(" + ", ".join(PRESENT_INPUT) + ") IS NOT NULL"
    recurring = f"NOT COALESCE(charge_type IN {ONE_TIME}, FALSE)"
    return f"""
base AS (SELECT *, {absent} FROM billing_lines WHERE {not_blank}),
br AS (SELECT *, {branch_sql()} AS branch FROM base),
parsed AS (
  SELECT *, {parse_cols_sql()},
    strftime({parse_ts('invoice_date')}, '%Y-%m-%d') AS inv_norm,
    (invoice_date IS NOT NULL AND {parse_ts('invoice_date')} IS NULL) AS inv_bad,
    {recurring} AS recurring
  FROM br),
pre_err AS (
  SELECT *, CASE WHEN perr IS NOT NULL THEN '1' || row_id
                 WHEN inv_bad THEN '2' || row_id END AS err_key,
            CASE WHEN perr IS NOT NULL THEN perr
                 WHEN inv_bad THEN {q(fixed.ERR_INVOICE_DATE)} END AS err_code
  FROM parsed),
doc_pre AS (
  SELECT document_id, COUNT(*) AS n_rows,
    first(inv_norm ORDER BY row_id) AS extraction_date,
    arg_min(err_code || ' at row ' || row_id, err_key) AS pre_error,
    COALESCE(bool_or(recurring AND bill_to_date IS NOT NULL), FALSE) AS has_bill_to
  FROM pre_err GROUP BY document_id),
latest AS (
  SELECT * FROM parsed
  WHERE recurring
  QUALIFY row_number() OVER (
    PARTITION BY document_id, COALESCE(billing_account_number, '') || COALESCE(service_id, '') || COALESCE(charge_description, '')
    ORDER BY {parse_ts('bill_to_date')} DESC NULLS LAST, row_id DESC) = 1),
vals AS (
  SELECT l.*, d.extraction_date, d.has_bill_to, d.pre_error,
    {money_sql('l.charge_amount')} AS charge, {money_sql('l.discount_amount')} AS discount,
    CASE WHEN {money_bad_sql('l.charge_amount')} THEN '3' || l.row_id
         WHEN {money_bad_sql('l.discount_amount')} THEN '4' || l.row_id END AS post_key,
    CASE WHEN {money_bad_sql('l.charge_amount')} THEN {q(fixed.ERR_CHARGE_AMOUNT)}
         WHEN {money_bad_sql('l.discount_amount')} THEN {q(fixed.ERR_DISCOUNT_AMOUNT)} END AS post_code,
    {units_num_sql(floor_units_sql('l.units'))} AS units_num,
    COALESCE({units_text_sql('l.units')}, 'nan') AS units_order,
    CASE WHEN l.bill_to_date IS NULL THEN CASE WHEN d.has_bill_to THEN TIMESTAMP '1900-01-01 00:00:00' END
         ELSE {parse_ts('l.bill_to_date')} END AS to_ts,
    {parse_ts('l.bill_from_date')} AS from_ts
  FROM latest l JOIN doc_pre d ON l.document_id = d.document_id),
enriched AS (
  SELECT *,
    {round3_sql("CASE WHEN units_num = 0 THEN NULL ELSE (charge - discount) / units_num END")} AS unit_recurring_cost,
    {quantity_sql('units_num')} AS service_quantity,
    {frequency_sql('to_ts', 'from_ts')} AS billing_frequency,
    COALESCE(currency, 'USD') AS currency_out,
    COALESCE(service_id, '') AS service_identifier,
    {location_a_sql('service_address_a', 'location_a_city', 'location_a_state', 'location_a_country')} AS location_a,
    {location_b_sql('service_address_b', 'location_z_city', 'location_z_state', 'location_z_country')} AS location_b,
    {doc_label_sql('document_id')} AS doc_label
  FROM vals),
doc_post AS (
  SELECT document_id, COUNT(*) AS n_kept, arg_min(post_code || ' at row ' || row_id, post_key) AS post_error
  FROM enriched GROUP BY document_id)
"""


def output_select_sql(vendor: str = "Carrier", owner: str = "") -> str:
    b = "CAST('' AS VARCHAR)"
    return f"""
  document_id,
  CAST(NULL AS VARCHAR) AS blank, {q(vendor)} AS vendor, billing_account_number AS account_identifier,
  pname AS product_name, service_quantity, unit_recurring_cost, billing_frequency,
  {b} AS unit_non_recurring_cost, currency_out AS currency, install_date AS service_start_date,
  {b} AS service_term, {b} AS service_end_date, service_identifier, location_a, location_b,
  {q(owner)} AS owner_email, {b} AS service_owner, {b} AS order_number, {b} AS order_date, doc_label AS doc_id,
  {b} AS a_location_name, carrier_circuit_id AS alternate_id, {b} AS vendor_bill_invoice_number,
  account_description_1 AS customer_name, bus_org_id AS customer_number, {b} AS data_source,
  internal_account_number AS vendor_internal_account_number, legacy_circuit_id AS vendor_legacy_circuit_id,
  product_family AS vendor_product_family, piid_product AS piid_parent, product_line AS vendor_product_line,
  {b} AS service_component_name, service_line AS vendor_service_line, {b} AS vendor_status, {b} AS vpn_id,
  {b} AS z_location_name, ident AS toll_free_number, extraction_date,
  bill_invoice_number AS latest_invoice_number, doc_label AS latest_doc_id,
  units_order, row_id AS row_ord"""


def normalized_sql(select: str | None = None) -> str:
    return with_billing_lines(f""", {stages_sql()}
SELECT {select or output_select_sql()}
FROM enriched
WHERE pre_error IS NULL
  AND document_id NOT IN (SELECT document_id FROM doc_post WHERE post_error IS NOT NULL)
""")


def doc_stats_sql() -> str:
    return f"""
doc_stats AS (
  SELECT p.document_id, p.n_rows, p.extraction_date, p.pre_error, q.post_error, COALESCE(q.n_kept, 0) AS n_kept
  FROM doc_pre p LEFT JOIN doc_post q ON p.document_id = q.document_id),
manifest AS ({MANIFEST_SQL}),
outputs AS ({OUTPUTS_SQL}),
skips AS (
  SELECT m.manifest_ord, m.document_id, m.file_name,
    (CASE WHEN m.document_id IN (SELECT document_id FROM billing_lines) THEN '' ELSE {q(fixed.MSG_NOT_AT_SOURCE)} END)
    || (CASE WHEN m.document_id IN (SELECT document_id FROM outputs) THEN {q(fixed.MSG_ALREADY_DONE)} ELSE '' END) AS skip
  FROM manifest m),
status AS (
  SELECT s.manifest_ord, s.document_id, s.file_name,
    CASE WHEN s.skip <> '' THEN s.skip
         WHEN COALESCE(d.n_rows, 0) = 0 THEN {q(fixed.MSG_EMPTY_FILE)}
         WHEN d.pre_error IS NOT NULL THEN d.pre_error
         WHEN d.post_error IS NOT NULL THEN d.post_error
         WHEN COALESCE(d.n_kept, 0) = 0 THEN {q(fixed.MSG_EMPTY_AFTER_RULES)}
         ELSE '' END AS error,
    CASE WHEN s.skip <> '' THEN 'skipped'
         WHEN COALESCE(d.n_rows, 0) = 0 THEN 'rejected'
         WHEN d.pre_error IS NOT NULL OR d.post_error IS NOT NULL THEN 'exception'
         WHEN COALESCE(d.n_kept, 0) = 0 THEN 'rejected' END AS error_kind,
    CASE WHEN s.skip <> '' THEN 0 ELSE COALESCE(d.n_rows, 0) END AS n_rows,
    CASE WHEN s.skip <> '' THEN 0 ELSE COALESCE(d.n_kept, 0) END AS n_kept, d.extraction_date AS first_date
  FROM skips s LEFT JOIN doc_stats d ON s.document_id = d.document_id),
status_final AS (
  SELECT manifest_ord, document_id, file_name,
    CASE WHEN error = '' THEN first_date ELSE '' END AS extraction_date, error,
    CASE WHEN error = '' THEN 'Success' ELSE 'Error' END AS status, error_kind,
    CAST(n_rows AS BIGINT) AS n_rows, CAST(n_kept AS BIGINT) AS n_kept
  FROM status)
"""


def status_sql(select: str) -> str:
    return with_billing_lines(f""", {stages_sql()}, {doc_stats_sql()}
{select}
""")
