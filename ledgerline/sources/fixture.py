"""The `billing_lines` fixture: invoice lines derived from the driver's tables.

It maps lineitem x orders x part onto the invoice contract (canonical names,
all text) and reaches every description branch, missing keys, small, blank,
missing and comma units, '$' and parenthesis money, missing end dates, a
document whose lines carry a description error (DOC-8, DOC-9), a document
made only of one-time charges (DOC-10), documents with an unreadable invoice date
(DOC-5), discount (DOC-6) and charge (DOC-7), no-break spaces in money and units, and dates
in two layouts. The same rows are produced by
``BILLING_LINES_SQL`` for the DuckDB oracle.

Also: the fixture "run" (manifest from `customer`, already-converted outputs
from `region`), so status, counts and run records grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, plan_settings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    plan_settings(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table columns that the fixture's lines are made of (narrower than the lines)."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_shipdate",
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    # lineitem x orders is a shuffle (sort-merge) join on the order key, as it
    # is at scale where neither side is small; its output is spread over the
    # shuffle partitions even when a file is a single row group.
    j = li.join(orders.hint("merge"), li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    return j.drop("o_orderkey", "p_partkey")


def line_columns() -> dict[str, Column]:
    """The columns of ``billing_lines``, over those of ``joined_lines``."""
    ok, pk, sk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    name = F.col("p_name")
    branch = (ok % 10).cast("int")
    desc = (
        F.when(branch == 0, F.concat(name, F.lit("-Circuit ID: C"), _s(pk), F.lit(" Customer Reference ID: R"), _s(sk), F.lit("-tail one-two")))
        .when(branch == 1, F.concat(name, F.lit(" Customer Reference ID: R"), _s(sk), F.lit("-tail")))
        .when(branch == 2, F.concat(name, F.lit("-Circuit ID: C"), _s(pk), F.lit(" extra words")))
        .when(branch == 3, F.concat(name, F.lit("- Circuit ID: C"), _s(pk)))
        .when(branch == 4, F.concat(name, F.lit("- Toll Free: 800"), _s(pk), F.lit("-x")))
        .when(branch == 5, F.concat(name, F.lit("-Toll Free: 888"), _s(pk)))
        .when(branch == 6, F.concat(F.lit("TN Fee - "), _s(pk % 5)))
        .when(branch == 7, F.concat(F.lit("Business White Pages Listing - page "), _s(pk % 5)))
        .when(branch == 8, F.lit("Business White Pages Listing none"))
        .otherwise(name)
    )
    document_id = (
        F.when(branch == 8, F.concat(F.lit("DOC-"), _s(F.lit(8) + F.col("o_custkey") % 2)))
        .when((branch == 9) & (F.col("l_returnflag") == "R"), F.lit("DOC-10"))
        .otherwise(F.concat(F.lit("DOC-"), _s(F.col("o_custkey") % 8)))
    )
    nbsp = F.lit("\u00a0")
    ordered = F.col("o_orderdate").cast("date")
    rare = pk % 20 == 0  # rows that make their document fail
    in_doc = lambda n: document_id == F.lit(f"DOC-{n}")
    return {
        "row_id": F.concat_ws("/", _s(ok), _s(ln), _s(pk), _s(sk), _s(F.col("l_quantity")), _s(F.col("l_extendedprice"))),
        "document_id": document_id,
        "billing_account_number": _s(F.col("o_custkey")),
        "service_id": F.when(sk % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("SVC-"), _s(sk))),
        "charge_description": desc,
        "charge_type": F.when(F.col("l_returnflag") == "R", "NON-RECURRING").when(F.col("l_returnflag") == "A", "Usage")
        .otherwise("Recurring"),
        "product_line": F.when(F.col("p_type") == "ECONOMY", "HSIP").when(F.col("p_type") == "PROMO", "Wavelength")
        .otherwise(F.col("p_type")),
        "piid_product": F.when(F.col("p_size") % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("PIID-"), _s(F.col("p_size")))),
        "charge_amount": F.when(in_doc(7) & rare, F.lit("on request")).when(ln == 6, F.concat(F.lit("$"), nbsp, _s(F.col("l_extendedprice"))))
        .otherwise(F.concat(F.lit("$"), _s(F.col("l_extendedprice")))),
        "discount_amount": F.when(in_doc(6) & rare, F.lit("10%")).otherwise(F.concat(F.lit("("), _s(ln * 10), F.lit(".00)"))),
        "units": F.when(ln == 1, F.lit("")).when(ln == 2, F.lit("0.5")).when(ln == 3, F.lit(None).cast("string"))
        .when(ln == 4, F.lit("1,000")).when(ln == 6, F.concat(nbsp, _s(F.col("l_quantity"))))
        .otherwise(_s(F.col("l_quantity"))),
        "currency": F.when(sk % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("EUR")),
        "service_address_a": F.col("p_brand"),
        "location_a_city": F.when(ln == 6, F.lit(None).cast("string")).otherwise(F.col("p_type")),
        "location_a_state": F.when(ln == 2, F.lit(None).cast("string")).otherwise(F.col("o_orderstatus")),
        "location_a_country": F.lit("US"),
        "invoice_date": F.when(in_doc(5) & rare, F.lit("soon")).when(ln == 2, F.date_format(ordered, "M/d/yyyy")).otherwise(_s(ordered)),
        "bill_from_date": F.when(ln == 3, F.date_format(ordered, "M/d/yyyy")).otherwise(_s(ordered)),
        "bill_to_date": F.when(ln == 5, F.lit(None).cast("string")).otherwise(_s(F.col("l_shipdate"))),
    }


def billing_lines(spark: SparkSession, sf_dir: str, joined: DataFrame | None = None) -> DataFrame:
    """``joined``: the ``joined_lines``, if they are written already."""
    joined = joined_lines(spark, sf_dir) if joined is None else joined
    return joined.select(*[c.alias(n) for n, c in line_columns().items()])


def written_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``joined_lines`` as a table: the join's shuffles, wider than it, are gone before the next ones are written."""
    return materialize(joined_lines(spark, sf_dir), "fixture-lines")


# The same view for DuckDB (the oracle side). Kept in step with billing_lines().
BILLING_LINES_SQL = """
SELECT * EXCLUDE (rare) REPLACE (
  CASE WHEN document_id = 'DOC-7' AND rare THEN 'on request' ELSE charge_amount END AS charge_amount,
  CASE WHEN document_id = 'DOC-6' AND rare THEN '10%' ELSE discount_amount END AS discount_amount,
  CASE WHEN document_id = 'DOC-5' AND rare THEN 'soon' ELSE invoice_date END AS invoice_date)
FROM (SELECT l.l_partkey % 20 = 0 AS rare, CAST(l.l_orderkey AS VARCHAR) || '/' || CAST(l.l_linenumber AS VARCHAR) || '/' || CAST(l.l_partkey AS VARCHAR)
    || '/' || CAST(l.l_suppkey AS VARCHAR) || '/' || CAST(l.l_quantity AS VARCHAR)
    || '/' || CAST(l.l_extendedprice AS VARCHAR) AS row_id,
  CASE WHEN l.l_orderkey % 10 = 8 THEN 'DOC-' || CAST(8 + o.o_custkey % 2 AS VARCHAR)
       WHEN l.l_orderkey % 10 = 9 AND l.l_returnflag = 'R' THEN 'DOC-10'
       ELSE 'DOC-' || CAST(o.o_custkey % 8 AS VARCHAR) END AS document_id,
  CAST(o.o_custkey AS VARCHAR) AS billing_account_number,
  CASE WHEN l.l_suppkey % 7 = 0 THEN NULL ELSE 'SVC-' || CAST(l.l_suppkey AS VARCHAR) END AS service_id,
  CASE CAST(l.l_orderkey % 10 AS INT)
    WHEN 0 THEN p.p_name || '-Circuit ID: C' || CAST(l.l_partkey AS VARCHAR) || ' Customer Reference ID: R'
             || CAST(l.l_suppkey AS VARCHAR) || '-tail one-two'
    WHEN 1 THEN p.p_name || ' Customer Reference ID: R' || CAST(l.l_suppkey AS VARCHAR) || '-tail'
    WHEN 2 THEN p.p_name || '-Circuit ID: C' || CAST(l.l_partkey AS VARCHAR) || ' extra words'
    WHEN 3 THEN p.p_name || '- Circuit ID: C' || CAST(l.l_partkey AS VARCHAR)
    WHEN 4 THEN p.p_name || '- Toll Free: 800' || CAST(l.l_partkey AS VARCHAR) || '-x'
    WHEN 5 THEN p.p_name || '-Toll Free: 888' || CAST(l.l_partkey AS VARCHAR)
    WHEN 6 THEN 'TN Fee - ' || CAST(l.l_partkey % 5 AS VARCHAR)
    WHEN 7 THEN 'Business White Pages Listing - page ' || CAST(l.l_partkey % 5 AS VARCHAR)
    WHEN 8 THEN 'Business White Pages Listing none'
    ELSE p.p_name END AS charge_description,
  CASE l.l_returnflag WHEN 'R' THEN 'NON-RECURRING' WHEN 'A' THEN 'Usage' ELSE 'Recurring' END AS charge_type,
  CASE p.p_type WHEN 'ECONOMY' THEN 'HSIP' WHEN 'PROMO' THEN 'Wavelength' ELSE p.p_type END AS product_line,
  CASE WHEN p.p_size % 6 = 0 THEN NULL ELSE 'PIID-' || CAST(p.p_size AS VARCHAR) END AS piid_product,
  CASE l.l_linenumber WHEN 6 THEN '$' || chr(160) ELSE '$' END || CAST(l.l_extendedprice AS VARCHAR) AS charge_amount,
  '(' || CAST(l.l_linenumber * 10 AS VARCHAR) || '.00)' AS discount_amount,
  CASE l.l_linenumber WHEN 1 THEN '' WHEN 2 THEN '0.5' WHEN 3 THEN NULL WHEN 4 THEN '1,000'
    WHEN 6 THEN chr(160) || CAST(l.l_quantity AS VARCHAR) ELSE CAST(l.l_quantity AS VARCHAR) END AS units,
  CASE WHEN l.l_suppkey % 5 = 0 THEN NULL ELSE 'EUR' END AS currency,
  p.p_brand AS service_address_a,
  CASE WHEN l.l_linenumber = 6 THEN NULL ELSE p.p_type END AS location_a_city,
  CASE WHEN l.l_linenumber = 2 THEN NULL ELSE o.o_orderstatus END AS location_a_state,
  'US' AS location_a_country,
  CASE l.l_linenumber WHEN 2 THEN strftime(CAST(o.o_orderdate AS DATE), '%-m/%-d/%Y') ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS invoice_date,
  CASE l.l_linenumber WHEN 3 THEN strftime(CAST(o.o_orderdate AS DATE), '%-m/%-d/%Y') ELSE CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) END AS bill_from_date,
  CASE WHEN l.l_linenumber = 5 THEN NULL ELSE CAST(l.l_shipdate AS VARCHAR) END AS bill_to_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)
"""


def with_billing_lines(sql: str) -> str:
    """Prefix an oracle query with the fixture view as a CTE."""
    return f"WITH billing_lines AS ({BILLING_LINES_SQL})\n{sql}"


# --- documents with date layouts of their own (row_id, document_id, invoice_date) ---------------

#: Layout of each document's invoice dates: Spark's letters, and DuckDB's. The others keep their two layouts and unreadable texts.
DATE_LAYOUTS = {
    "DOC-0": ("yyyy-MM-dd", "%Y-%m-%d"), "DOC-1": ("dd/MM/yyyy", "%d/%m/%Y"), "DOC-2": ("d-MMM-yyyy", "%-d-%b-%Y"), "DOC-3": ("yyyyMMdd", "%Y%m%d"),
    "DOC-4": ("M/d/yyyy", "%-m/%-d/%Y"), "DOC-6": ("MMM d, yyyy", "%b %-d, %Y"), "DOC-7": ("dd.MM.yyyy", "%d.%m.%Y"), "DOC-9": ("MM-dd-yyyy", "%m-%d-%Y"),
    "DOC-10": ("yyyy/M/d", "%Y/%-m/%-d"),
}
#: Days up to the twelfth only, written day first: nothing in the document says so.
AMBIGUOUS = "DOC-8"


def dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = billing_lines(spark, sf_dir).select("row_id", "document_id", F.col("invoice_date").alias("_text"))
    day = F.coalesce(F.try_to_timestamp("_text", F.lit("yyyy-MM-dd")), F.try_to_timestamp("_text", F.lit("M/d/yyyy")))
    lines = lines.withColumn("_day", day)
    out = F.when(F.col("document_id") == AMBIGUOUS, F.when(F.dayofmonth("_day") <= 12, F.date_format("_day", "d/M/yyyy")))
    for doc, (fmt, _) in DATE_LAYOUTS.items():
        out = out.when(F.col("document_id") == doc, F.date_format("_day", fmt))
    return lines.select("row_id", "document_id", out.otherwise(F.col("_text")).alias("invoice_date"))


DATED_LINES_SQL = f"""SELECT row_id, document_id, CASE WHEN document_id = '{AMBIGUOUS}' THEN CASE WHEN day(d) <= 12 THEN strftime(d, '%-d/%-m/%Y') END
  {" ".join(f"WHEN document_id = '{doc}' THEN strftime(d, '{fmt}')" for doc, (_, fmt) in DATE_LAYOUTS.items())} ELSE invoice_date END AS invoice_date
FROM (SELECT *, coalesce(try_strptime(invoice_date, '%Y-%m-%d'), try_strptime(invoice_date, '%m/%d/%Y')) AS d FROM billing_lines)"""


# --- the fixture run: manifest, sources present, outputs already converted ---

def fixture_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest record per document label DOC-0..DOC-12, from `customer`,
    with the manifest's own order (`manifest_ord`)."""
    cust = _table(spark, sf_dir, "customer").select("c_custkey")
    n = (F.col("c_custkey") % 13).cast("int")
    return (
        cust.groupBy(n.alias("manifest_ord"))
        .agg(F.count(F.lit(1)).alias("n_customers"))
        .select(
            "manifest_ord",
            F.concat(F.lit("DOC-"), _s(F.col("manifest_ord"))).alias("document_id"),
            F.concat(F.lit("DOC-"), _s(F.col("manifest_ord")), F.lit("-invoice.csv")).alias("file_name"),
        )
    )


def fixture_sources(lines: DataFrame) -> DataFrame:
    """Documents present at the source: those with invoice lines."""
    return lines.select("document_id").distinct()


def fixture_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents already converted: DOC-9, DOC-11, ... from `region` keys."""
    reg = _table(spark, sf_dir, "region").select("r_regionkey")
    return reg.select(F.concat(F.lit("DOC-"), _s(F.col("r_regionkey") * 2 + 9)).alias("document_id"))


MANIFEST_SQL = """
SELECT CAST(c_custkey % 13 AS INT) AS manifest_ord,
       'DOC-' || CAST(CAST(c_custkey % 13 AS INT) AS VARCHAR) AS document_id,
       'DOC-' || CAST(CAST(c_custkey % 13 AS INT) AS VARCHAR) || '-invoice.csv' AS file_name
FROM customer GROUP BY 1, 2, 3
"""
OUTPUTS_SQL = "SELECT 'DOC-' || CAST(r_regionkey * 2 + 9 AS VARCHAR) AS document_id FROM region"
