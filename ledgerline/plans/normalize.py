"""normalize_bills: the whole per-document transform as one plan over all documents.

Order of the rules (part of the semantics): C1 -> C4 -> P1/P2 on every row
(A1 and the description/date errors look at rows F1 later removes) -> F1 ->
P3 -> W1 -> P5..P17 on the kept rows (money errors only count there) -> C5,
C6, C8 -> document gate (a document with any row error, or with no row left,
has no output).

Physical shape, chosen for skewed invoice data (one document or one key may
hold a third of all rows):

1. ONE shuffle, keyed by (document, business key): a partial/final
   aggregate that picks the W1 row (``max_by`` over (bill-to order, row)
   among recurring rows) and, in the same pass, per-group partials of the
   per-document values (row count, first row and its invoice date, first
   row error, any bill-to date). Map tasks send one record per key, so a hot
   key or document does not pile up in one task.
2. For the output rows the group table is written once as Parquet under the
   checkpoint folder: the two consumers below read it (pruning to the fields
   they need) instead of rescanning the input, and lineage is cut. Where only the
   per-document values are asked for, groups carry no more than these need and are not written.
3. A per-document aggregate over the groups (partial/final; tiny output).
4. The kept rows join the per-document values (AQE broadcasts them when the
   runtime size is small, else a sort-merge join with skew splitting) and
   get every output value as JVM expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import dates, money, text
from ..functions.describe import description_branch, description_error, parse_charge_description
from ..functions.text import packed_texts, unpacked_texts
from ..operators import contract
from ..operators.dedupe import bill_to_for_frequency, bill_to_order
from ..operators.filters import is_one_time
from ..operators.sheet import output_columns
from ..params import JobParams
from ..session import drop_materialized, materialize, plan_settings

INPUT_COLUMNS = list(fixed.CANONICAL_NAMES.values())


DATE_COLUMNS = ["invoice_date", "bill_to_date", "bill_from_date"]


class Normalized:
    """The results of ``normalize_bills``, each computed when first asked for. ``rows`` writes the group table, which ``doc_stats``
    reads if it is there."""

    def __init__(self, groups: Callable[[bool], DataFrame], stats: Callable[[DataFrame], DataFrame],
                 output: Callable[[DataFrame, DataFrame], DataFrame], rejects: Callable[[], DataFrame] | None):
        self._group, self._stats, self._output, self._reject = groups, stats, output, rejects

    @cached_property
    def _groups(self) -> DataFrame:
        return materialize(self._group(True), "w1-groups")

    @cached_property
    def _all_stats(self) -> DataFrame:
        written = "_groups" in self.__dict__
        return materialize(self._stats(self._groups if written else self._group(False)), "doc-stats")

    @cached_property
    def rows(self) -> DataFrame:
        """document_id, the 40 sheet columns, units_order, row_ord"""
        groups = self._groups
        return self._output(groups, self._all_stats)

    def drop_groups(self) -> None:
        """Deletes the group table. For when ``rows`` has been written elsewhere and isn't read again; ``doc_stats`` stays."""
        drop_materialized(self._groups)

    @property
    def doc_stats(self) -> DataFrame:
        """per document: n_rows, extraction_date, pre_error, post_error, n_kept"""
        return self._all_stats.drop("has_bill_to")

    @cached_property
    def rejects(self) -> DataFrame | None:
        """(keep_rejects) document_id, row_ord, errors of every row with any"""
        return materialize(self._reject(), "rejects") if self._reject else None


def _err(stage: int, row: Column, code) -> Column:
    code = code if isinstance(code, Column) else F.lit(code)
    return F.struct(F.lit(stage).alias("stage"), row.alias("row"), code.alias("code"))


def normalize_bills(lines: DataFrame, params: JobParams = JobParams(), doc: str = "document_id",
                    row_ord: str = "row_ord", file_col: str | None = None) -> Normalized:
    """Normalize invoice lines (canonical text columns + ``doc`` + ``row_ord``).

    ``file_col`` names the source file (for the DocID label); without it the
    label is taken from ``doc``. The results are computed when they are first
    asked for: ``rows`` writes the group table and is lazy over it.

    With ``date_mode="infer"`` a pass over the date columns finds each document's layouts first.

    With ``keep_rejects`` the rows with any error are a pass of their own over the input, in which only they are
    shuffled. A row's errors are all that the rules find in it; those in amounts fail a document only on rows that W1 keeps.
    """
    plan_settings(lines.sparkSession)
    present = [c for c in INPUT_COLUMNS if c in lines.columns]
    rows = contract.drop_blank_rows(lines, present)  # C1
    rows = contract.add_optional(rows)  # C4
    label_src = F.col(file_col) if file_col else F.col(doc)
    layouts = None
    if params.date_mode == "infer":
        layouts = materialize(dates.inferred_layouts(rows, doc, row_ord, [c for c in DATE_COLUMNS if c in rows.columns], params.inferred_formats), "date-layouts")
        rows = rows.join(layouts, doc, "left")
    elif params.date_mode != "formats":
        raise ValueError(f"unknown date mode {params.date_mode!r}")

    def date(column: str) -> Column:
        if layouts is not None:
            return dates.parse_by_layout(F.col(column), F.col(f"{column}_layout"), params.inferred_formats)
        return dates.parse_timestamp(F.col(column), params.date_formats)

    # P1 errors on every row; the identifier and product name are split out
    # after W1, for the kept rows only.
    parsed = rows.withColumns({
        "_branch": description_branch(F.col("charge_description")),
        "_inv_ts": date("invoice_date"),  # P2
    })
    parsed = parsed.withColumn("description_error", description_error(F.col("charge_description"), F.col("_branch")))
    inv_date = F.date_format(F.col("_inv_ts"), "yyyy-MM-dd")
    inv_bad = F.col("invoice_date").isNotNull() & F.col("_inv_ts").isNull()
    ro = F.col(row_ord)
    too_long = F.col("row_too_long") if "row_too_long" in parsed.columns else F.lit(False)
    parsed = parsed.withColumns({
        "invoice_date_norm": inv_date,
        "_pre_err": F.when(too_long, _err(fixed.STAGE_ROW_SHAPE, ro, fixed.ERR_ROW_TOO_LONG))
                     .when(F.col("description_error").isNotNull(),
                           _err(fixed.STAGE_DESCRIPTION, ro, F.col("description_error")))
                     .when(inv_bad, _err(fixed.STAGE_INVOICE_DATE, ro, fixed.ERR_INVOICE_DATE)),
        "_recurring": ~is_one_time("charge_type"),  # F1
        "_key": text.business_key(F.col("billing_account_number"), F.col("service_id"),
                                  F.col("charge_description")),  # P3
        "_order": date("bill_to_date") if layouts is not None and params.latest_order == "parsed"
                  else bill_to_order(F.col("bill_to_date"), params.latest_order, params.date_formats),
        "doc_label": text.doc_label(label_src),
    })

    # 1-2. W1 and per-group partials in one shuffle.
    # Only what the output needs rides through the shuffle (not the charge
    # type, invoice date or service number).
    not_needed = {"charge_type", "invoice_date", "service_number"}
    carried = [c for c in (*INPUT_COLUMNS, "doc_label", row_ord)
               if c in parsed.columns and c not in not_needed]
    carried = list(dict.fromkeys(carried))
    # the statistics need the amounts; with all columns before these, equal rows' tie goes as with all columns
    amounts = [c for c in carried[: max((carried.index(c) for c in ("charge_amount", "discount_amount")), default=-1) + 1] if c != row_ord] + [row_ord]
    # W1 pick: the max of (order among recurring rows, row); non-recurring rows
    # have a NULL order, which sorts lowest, and carry no values.
    recurring_order = F.when(F.col("_recurring"), F.struct(F.col("_order").alias("o"), ro.alias("r")))

    def grouped(whole: bool) -> DataFrame:
        # The values go as one text, and the row's number only as what orders it. One-time rows count for their document alone:
        # they have no key, so that a map task sends one record of them per document.
        texts = [c for c in (carried if whole else amounts) if c != row_ord]
        values = packed_texts([F.col(c).cast("string") for c in texts])
        groups = parsed.groupBy(doc, F.when(F.col("_recurring"), F.col("_key")).alias("_key")).agg(
            F.max(F.struct(recurring_order.alias("k"), F.when(F.col("_recurring"), values).alias("v"))).alias("_w1"),
            F.count(F.lit(1)).alias("g_rows"),
            F.min(F.struct(ro.alias("row"), F.col("invoice_date_norm").alias("date"))).alias("g_first"),
            F.min("_pre_err").alias("g_pre_err"),
            F.max(F.when(F.col("_recurring"), F.col("bill_to_date").isNotNull())).alias("g_has_bill_to"),
        )
        groups = groups.withColumn("_texts", unpacked_texts(F.col("_w1.v")))
        kinds = dict(parsed.dtypes)
        kept = F.struct(*[F.get("_texts", F.lit(i)).cast(kinds[c]).alias(c) for i, c in enumerate(texts)], F.col("_w1.k.r").alias(row_ord))
        return groups.withColumns({
            "g_kept": F.col("_w1.k").isNotNull(),  # a flag of its own: tests on it do not read the whole row struct
            "w1": F.when(F.col("_w1.k").isNotNull(), kept),
        }).drop("_w1", "_key", "_texts")

    def rejected() -> DataFrame:
        errors = error_codes(too_long, inv_bad, params)
        bad = parsed.filter(reduce(or_, [F.coalesce(is_bad, F.lit(False)) for is_bad, _ in errors]) & ro.isNotNull())
        bad = bad.select(doc, "_key", ro.alias("row_ord"), row_errors(errors).alias("_errors"))
        return bad.groupBy(doc, "_key", "row_ord").agg(F.max("_errors").alias("errors")).drop("_key")

    # Money errors on the kept row of each group (P5), known before the gate.
    w = lambda c: F.col(f"w1.{c}")
    charge, charge_bad = money.clean_money(w("charge_amount"), params.paren_negative)
    discount, discount_bad = money.clean_money(w("discount_amount"), params.paren_negative)
    post_err = (F.when(charge_bad, _err(fixed.STAGE_CHARGE_AMOUNT, w(row_ord), fixed.ERR_CHARGE_AMOUNT))
                .when(discount_bad, _err(fixed.STAGE_DISCOUNT_AMOUNT, w(row_ord), fixed.ERR_DISCOUNT_AMOUNT)))

    # 3. Per-document values (A1, first errors, P4 flag, kept rows).
    def stats(groups: DataFrame) -> DataFrame:
        return groups.groupBy(doc).agg(
            F.sum("g_rows").alias("n_rows"),
            F.min("g_first")["date"].alias("extraction_date"),
            F.min("g_pre_err").alias("pre_error"),
            F.min(F.when(F.col("g_kept"), post_err)).alias("post_error"),
            F.count_if(F.col("g_kept")).alias("n_kept"),
            # a set of booleans, for the kind of aggregate: with it Spark hashes, without it all groups would be sorted by document
            F.array_contains(F.collect_set("g_has_bill_to"), True).alias("has_bill_to"),
        )

    # 4. Kept rows with every output value; gate documents with errors.
    def output(groups: DataFrame, doc_stats: DataFrame) -> DataFrame:
        return _output_rows(groups, doc_stats, params, doc, row_ord, layouts, date)

    return Normalized(grouped, stats, output, rejected if params.keep_rejects else None)


def _output_rows(groups: DataFrame, doc_stats: DataFrame, params: JobParams, doc: str, row_ord: str, layouts: DataFrame | None,
                 date: Callable[[str], Column]) -> DataFrame:
    good_docs = doc_stats.filter(F.col("pre_error").isNull() & F.col("post_error").isNull()).select(
        doc, "extraction_date", "has_bill_to")
    if layouts is not None:
        good_docs = good_docs.join(layouts, doc, "left")
    kept = groups.filter(F.col("g_kept")).select(doc, "w1.*").join(good_docs, doc, "inner")
    kept = parse_charge_description(kept)  # P1 identifier and product name
    # Each reused value gets its own column (computed once per row).
    staged = money.with_money(kept, "charge_amount", "_charge", params.paren_negative)  # P5
    staged = money.with_money(staged, "discount_amount", "_discount", params.paren_negative)
    staged = money.with_units(staged, "units", "_u")  # P6, P7
    staged = staged.withColumns({
        "_to": bill_to_for_frequency(date("bill_to_date"), F.col("bill_to_date"), F.col("has_bill_to")),  # P4, P11
        "_from": date("bill_from_date"),  # P11
    })
    staged = staged.withColumns({
        "_freq": dates.billing_frequency(F.col("_to"), F.col("_from")),  # P12
        "_units": F.col("_u_num"),
    })
    staged = staged.withColumns({
        "_cost": money.unit_cost(F.col("_charge"), F.col("_discount"), F.col("_units")),  # P8
        "_q": money.rounded_units(F.col("_units")),
    })
    enriched = staged.withColumns({
        "unit_recurring_cost": money.round3(F.col("_cost")),  # P9
        "service_quantity": money.quantity_from_rounded(F.col("_q")),  # P10
        "billing_frequency": dates.clamp_frequency(F.col("_freq")),  # P13
        "currency": text.fill_currency(F.col("currency")),  # P14
        "service_identifier": text.fill_blank(F.col("service_id")),  # P15
        "location_a": text.location_a(F.col("service_address_a"), F.col("location_a_city"),
                                      F.col("location_a_state"), F.col("location_a_country")),  # P16
        "location_b": text.location_b(F.col("service_address_b"), F.col("location_z_city"),
                                      F.col("location_z_state"), F.col("location_z_country"), params.null_token),  # P17
        "units_order": F.coalesce(F.col("_u_text"), F.lit("nan")),  # O3 tie order
    })
    return enriched.select(
        F.col(doc),
        *output_columns(enriched, params, F.col("doc_label"), F.col("extraction_date")),  # C5, C6, C8
        F.col("units_order"),
        F.col(row_ord).alias("row_ord"),
    )


def error_codes(too_long: Column, bad_invoice_date: Column, params: JobParams) -> list[tuple[Column, Column]]:
    """(whether a row has it, its code) of every error, in stage order."""
    _, bad_charge = money.clean_money(F.col("charge_amount"), params.paren_negative)
    _, bad_discount = money.clean_money(F.col("discount_amount"), params.paren_negative)
    return [(too_long, F.lit(fixed.ERR_ROW_TOO_LONG)), (F.col("description_error").isNotNull(), F.col("description_error")),
            (bad_invoice_date, F.lit(fixed.ERR_INVOICE_DATE)), (bad_charge, F.lit(fixed.ERR_CHARGE_AMOUNT)), (bad_discount, F.lit(fixed.ERR_DISCOUNT_AMOUNT))]


def row_errors(errors: list[tuple[Column, Column]]) -> Column:
    """Every error code of a row, in stage order."""
    return F.array_compact(F.array(*[F.when(bad, code) for bad, code in errors]))
