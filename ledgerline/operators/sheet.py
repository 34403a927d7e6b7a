"""The normalized table and the upload sheet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.text import packed_texts, unpacked_texts
from ..params import JobParams
from .filters import exclude_product_lines
from .ordering import ordered_row_number

SHEET_NAMES = [c for _, c in fixed.SHEET_COLUMNS]
NUMERIC_TYPES = {"service_quantity": "long", "unit_recurring_cost": "double", "billing_frequency": "double"}
PREAMBLE_ROWS = 8  # blank header row, title, blank, client, user, stamp, blank, column headers


def _s(value: str) -> Column:
    return F.lit(value).cast("string")


def output_columns(df: DataFrame, params: JobParams, label: Column, extraction_date: Column) -> list[Column]:
    """C5 (copies/renames) and C6 (constants) for the 40 sheet columns, in order."""
    blank = _s("")
    src = {
        "blank": F.lit(None).cast("string"),
        "vendor": _s(params.vendor),
        "account_identifier": F.col("billing_account_number"),
        "product_name": F.col("product_name"),
        "service_quantity": F.col("service_quantity"),
        "unit_recurring_cost": F.col("unit_recurring_cost"),
        "billing_frequency": F.col("billing_frequency"),
        "unit_non_recurring_cost": blank,
        "currency": F.col("currency"),
        "service_start_date": F.col("install_date"),
        "service_term": blank,
        "service_end_date": blank,
        "service_identifier": F.col("service_identifier"),
        "location_a": F.col("location_a"),
        "location_b": F.col("location_b"),
        "owner_email": _s(params.default_owner_email),
        "service_owner": blank,
        "order_number": blank,
        "order_date": blank,
        "doc_id": label,
        "a_location_name": blank,
        "alternate_id": F.col("carrier_circuit_id"),
        "vendor_bill_invoice_number": blank,
        "customer_name": F.col("account_description_1"),
        "customer_number": F.col("bus_org_id"),
        "data_source": blank,
        "vendor_internal_account_number": F.col("internal_account_number"),
        "vendor_legacy_circuit_id": F.col("legacy_circuit_id"),
        "vendor_product_family": F.col("product_family"),
        "piid_parent": F.col("piid_product"),
        "vendor_product_line": F.col("product_line"),
        "service_component_name": blank,
        "vendor_service_line": F.col("service_line"),
        "vendor_status": blank,
        "vpn_id": blank,
        "z_location_name": blank,
        "toll_free_number": F.col("toll_free_number"),
        "extraction_date": extraction_date,
        "latest_invoice_number": F.col("bill_invoice_number"),
        "latest_doc_id": label,
    }
    return [src[name].cast(NUMERIC_TYPES.get(name, "string")).alias(name) for name in SHEET_NAMES]


def append_filtered_copy(df: DataFrame, col: str = "product_line",
                         values: Sequence[str] = tuple(fixed.EXCLUDED_PRODUCT_LINES)) -> DataFrame:
    """The table followed by its rows whose product line is not excluded
    (those rows appear twice). Off in the composed job: its result was unused."""
    return df.unionByName(exclude_product_lines(df, col, values))


def sheet_order_keys(units_col: str = "units_order", row_ord: str = "row_ord") -> list[Column]:
    """O5 (with O3 as the tie order): service identifier, PIID (missing last),
    units text, then source row."""
    return [F.col("service_identifier").asc_nulls_first(), F.col("piid_parent").asc_nulls_last(),
            F.col(units_col).asc_nulls_first(), F.col(row_ord).asc_nulls_first()]


def sheet_order(normalized: DataFrame, doc: str = "document_id", out: str = "sheet_order",
                row_ord: str = "row_ord", pin_input: bool = True) -> DataFrame:
    """Position of each row in its document's sheet, numbered without
    sending a document to one task (see ``ordered_row_number``). The
    normalized rows are expression-heavy, so they are written once before the
    range partitioner samples them (``pin_input``)."""
    keys = {doc, "service_identifier", "piid_parent", "units_order", row_ord}
    texts = [c for c, kind in normalized.dtypes if kind == "string" and c not in keys]
    return ordered_row_number(normalized, [doc], sheet_order_keys(row_ord=row_ord), out=out, pin_input=pin_input, pack=texts)


def _preamble_cells(params: JobParams, stamp_text: Column) -> list[list[Column]]:
    b = _s(fixed.SHEET_BLANK_CELL)
    n = len(SHEET_NAMES)

    def line(second: Column | None) -> list[Column]:
        cells = [b] * n
        if second is not None:
            cells = [b, second] + [b] * (n - 2)
        return cells

    header_blank = [_s("")] * n
    headers = [_s(h) for h in params.sheet_headers()]
    return [
        header_blank,
        line(_s(fixed.SHEET_TITLE)),
        line(None),
        line(_s(params.client_name)),
        line(_s(fixed.SHEET_USER_LABEL + params.upload_user)),
        line(stamp_text),
        line(None),
        headers,
    ]


def _data_cells() -> list[Column]:
    return [F.col(name).cast("string").alias(f"_c{i}") for i, name in enumerate(SHEET_NAMES)]


def _preamble(docs: DataFrame, params: JobParams, stamp_text: Column, number: str) -> DataFrame:
    """``docs`` with the eight preamble rows of each: ``number`` (1 to 8) and the cells.
    They come from exploding an array of eight, not from a cross join."""
    structs = F.array(*[
        F.struct(F.lit(k + 1).cast("long").alias(number), *[c.alias(f"_c{i}") for i, c in enumerate(cells)])
        for k, cells in enumerate(_preamble_cells(params, stamp_text))
    ])
    return docs.select(*docs.columns, F.inline(structs))


def upload_sheet(normalized: DataFrame, params: JobParams, stamp_text: Column, doc: str = "document_id",
                 row_ord: str = "row_ord") -> DataFrame:
    """K1 + U2 + C9: sheet rows (doc, doc_label, sheet_row, _c0.._c39), all text.

    Rows 1-8 per document are the preamble (blank header row, title, blank,
    client, user, run stamp, blank, column headers), data from row 9 in O5
    order.
    """
    ordered = sheet_order(normalized, doc=doc, out="_o", row_ord=row_ord)
    data = ordered.select(
        F.col(doc), F.col("doc_id").alias("doc_label"), (F.col("_o") + F.lit(PREAMBLE_ROWS)).alias("sheet_row"), *_data_cells())
    docs = ordered.select(doc, F.col("doc_id").alias("doc_label")).distinct()  # from the written, ordered rows
    return _preamble(docs, params, stamp_text, "sheet_row").unionByName(data)


def write_sheets(normalized: DataFrame, params: JobParams, stamp_text: Column, path: str, output: str = "output",
                 row_ord: str = "row_ord") -> None:
    """K1 sink: one folder per output, headerless CSV, rows as in ``upload_sheet``.

    Files need the rows' order, not their numbers: one range partitioning on
    (output, preamble first, order keys) puts a large document into many tasks
    and part files in name order hold its rows in sheet order. The partitioner samples its
    input, so ``normalized`` should be a written table. An output that is written
    again replaces its earlier rows; others stay."""
    keys = {"_o0": "service_identifier", "_o1": "piid_parent", "_o2": "units_order", "_o3": row_ord}
    data = normalized.select(output, F.lit(9).cast("long").alias("_line"), *[F.col(c).alias(k) for k, c in keys.items()], *_data_cells())
    pre = _preamble(normalized.select(output).distinct(), params, stamp_text, "_line")
    rows = pre.unionByName(data, allowMissingColumns=True)
    order = [F.col(output), F.col("_line"), F.col("_o0").asc_nulls_first(), F.col("_o1").asc_nulls_last(),
             F.col("_o2").asc_nulls_first(), F.col("_o3").asc_nulls_first()]
    cells = [f"_c{i}" for i in range(len(SHEET_NAMES))]  # shuffled as one text
    rows = rows.select(output, "_line", *keys, packed_texts([F.col(c) for c in cells]).alias("_texts"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(output, unpacked_texts(F.col("_texts")).alias("_texts"))
    (rows.select(output, *[F.get("_texts", F.lit(i)).alias(c) for i, c in enumerate(cells)])
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(output)
     .option("header", False).option("escape", '"').csv(path))
