"""Dates, billing frequency and the run stamp.

Text is parsed with ``try_to_timestamp`` over a list of formats and kept as
TIMESTAMP_NTZ, so day counts do not depend on the session time zone. Either each value takes the
first format that fits it, or the layout is inferred for each document's whole column
(``inferred_layouts``, ``parse_by_layout``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

MICROS_PER_DAY = 86_400_000_000


_SEPARATORS = ("/", ":", "-", " ")


def _shape_fits(text: Column, fmt: str) -> Column:
    """Necessary condition for ``fmt`` to read ``text``: the same separator
    characters occur in both. It skips attempts that cannot succeed (a
    failed parse is far costlier than a substring test); results are unchanged."""
    literal = "".join(part for i, part in enumerate(fmt.split("'")) if i % 2 == 0)
    tests = [text.contains(ch) if ch in literal else ~text.contains(ch) for ch in _SEPARATORS]
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def parse_timestamp(c: Column, formats: Sequence[str] = tuple(fixed.DATE_FORMATS)) -> Column:
    """Text -> TIMESTAMP_NTZ using the first format that fits; else NULL."""
    text = c.cast("string")
    parsed = F.coalesce(*[F.when(_shape_fits(text, fmt), F.try_to_timestamp(text, F.lit(fmt))) for fmt in formats])
    return parsed.cast("timestamp_ntz")


# --- the layout of a whole column -------------------------------------------------------------

_SHAPES = {"yyyy": "[0-9]{4}", "MMM": "[A-Za-z]{3}", "MM": "[0-9]{2}", "dd": "[0-9]{2}", "mm": "[0-9]{2}", "ss": "[0-9]{2}",
           "M": "[0-9]{1,2}", "d": "[0-9]{1,2}", "H": "[0-9]{1,2}"}


def layout_shape(fmt: str) -> str:
    """The pattern of texts that look like ``fmt``: its letters as digits (or a month's name), all else as it is."""
    parts = re.split("('[^']*'|y+|M+|d+|H+|m+|s+)", fmt)
    return "^" + "".join(_SHAPES.get(p) or re.escape(p.strip("'")) for p in parts) + "$"


def _by_layout(text: Column, fmt: str) -> Column:
    return F.when(text.rlike(layout_shape(fmt)), F.try_to_timestamp(text, F.lit(fmt)))


def parse_by_layout(c: Column, layout: Column, formats: Sequence[str] = tuple(fixed.INFERRED_FORMATS)) -> Column:
    """Text -> TIMESTAMP_NTZ by the layout's number; NULL where the text isn't of that layout, or there is none."""
    text = c.cast("string")
    parsed = F.lit(None).cast("timestamp")
    for k in reversed(range(len(formats))):
        parsed = F.when(layout == k, _by_layout(text, formats[k])).otherwise(parsed)
    return parsed.cast("timestamp_ntz")


def inferred_layouts(rows: DataFrame, doc: str, order: str, columns: Sequence[str],
                     formats: Sequence[str] = tuple(fixed.INFERRED_FORMATS)) -> DataFrame:
    """Per document the layout (number in ``formats``) of each date column, as columns ``<column>_layout``.

    A column's layout is the first that fits all of its values, and of those rather one that fits all of the document's
    dates (a day above the twelfth in one column tells the others); if none does, the first that
    fits the first value (by ``order``), so that the others are the ones that don't fit; else NULL. Missing
    values have no say.

    Two aggregates: the distinct texts of each document (few dates, however many rows; combined map-side), whose
    fitting layouts are one bit each, then the bits that all texts share. No row is parsed more than once a layout and distinct text."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")) for c in columns]))
    texts = rows.select(doc, F.col(order).alias("_first"), cells.alias("_cell")).filter(F.col("_cell.text").isNotNull())
    texts = texts.groupBy(doc, F.col("_cell.column").alias("_column"), F.col("_cell.text").alias("_text")).agg(F.min("_first").alias("_first"))
    bits = [F.when(_by_layout(F.col("_text"), f).isNotNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, f in enumerate(formats)]
    fits = texts.select(doc, "_column", "_first", sum(bits[1:], bits[0]).alias("_fits"))
    found = fits.groupBy(doc, "_column").agg(F.bit_and("_fits").alias("_all"), F.min_by("_fits", "_first").alias("_one"))
    one = lambda name, c: F.max(F.when(F.col("_column") == c, F.col(name))).alias(f"{name}_{c}")
    found = found.groupBy(doc).agg(F.bit_and("_all").alias("_doc"), *[one(name, c) for name in ("_all", "_one") for c in columns])
    bit = lambda bits: F.coalesce(*[F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, F.lit(k)) for k in range(len(formats))])
    layout = lambda c: F.when(F.col(f"_all_{c}").isNotNull(), F.coalesce(bit(F.col("_doc")), bit(F.col(f"_all_{c}")), bit(F.col(f"_one_{c}"))))
    return found.select(doc, *[layout(c).alias(f"{c}_layout") for c in columns])


def normalize_invoice_date(c: Column, formats: Sequence[str] = tuple(fixed.DATE_FORMATS)) -> tuple[Column, Column]:
    """(text 'yyyy-MM-dd' or NULL, is_error). Missing stays missing; a
    non-missing text no format reads is an error."""
    ts = parse_timestamp(c, formats)
    return F.date_format(ts, "yyyy-MM-dd"), c.isNotNull() & ts.isNull()


def whole_days(to_ts: Column, from_ts: Column) -> Column:
    """Whole days of (to - from), floored (-6 hours is -1 day)."""
    micros = F.timestamp_diff("MICROSECOND", from_ts, to_ts)
    return F.floor(micros / F.lit(float(MICROS_PER_DAY)))


def billing_frequency(to_ts: Column, from_ts: Column) -> Column:
    """Whole days / 30, rounded half-even."""
    return F.rint(whole_days(to_ts, from_ts) / F.lit(30.0))


def clamp_frequency(freq: Column) -> Column:
    """Frequency <= 0.9 (zero, negative) -> 1; NULL stays NULL."""
    return F.when(freq <= F.lit(0.9), F.lit(1.0)).otherwise(freq)


def stamp(ts: Column) -> Column:
    """Run time stamp text 'dd-Mon-yyyy HH:MM:SS'."""
    return F.date_format(ts, fixed.STAMP_FORMAT)
