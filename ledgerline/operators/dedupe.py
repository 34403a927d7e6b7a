"""Keep the latest billing row per business key.

W1 is ``row_number() = 1`` over (document, key), which Spark plans as a
partial WindowGroupLimit before the shuffle and a final one after it: each
map task forwards at most one row per key, so a key holding a large share of
the rows does not pile up in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.dates import parse_timestamp


def bill_to_order(bill_to: Column, mode: str = "parsed", formats: Sequence[str] = tuple(fixed.DATE_FORMATS)) -> Column:
    """Ordering value of "Bill To Date" for W1: the parsed timestamp (default)
    or the raw text. Missing (and, when parsed, unreadable) sorts lowest."""
    if mode == "raw":
        return bill_to
    if mode != "parsed":
        raise ValueError(f"unknown order mode {mode!r}")
    return parse_timestamp(bill_to, formats)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column, tie: str = "row_ord") -> DataFrame:
    """The last row per key in (order, tie) order; ``order`` NULL sorts lowest."""
    w = Window.partitionBy(*keys).orderBy(order.desc_nulls_last(), F.col(tie).desc())
    return df.withColumn("_w1_rn", F.row_number().over(w)).filter(F.col("_w1_rn") == 1).drop("_w1_rn")


def has_value_flag(df: DataFrame, doc: str, col: str, out: str = "has_bill_to") -> DataFrame:
    """P4 helper: per document, whether any row has ``col`` set (partial aggregate)."""
    return df.groupBy(doc).agg(F.max(F.col(col).isNotNull()).alias(out))


def bill_to_for_frequency(bill_to_ts: Column, bill_to_raw: Column, has_bill_to: Column) -> Column:
    """A missing "Bill To Date" is the 1900-01-01 stand-in when the document
    has any other value (the stand-in then reaches the frequency), else missing."""
    sentinel = F.lit(fixed.BILL_TO_SENTINEL).cast("date").cast("timestamp_ntz")
    return F.when(bill_to_raw.isNull(), F.when(has_bill_to, sentinel)).otherwise(bill_to_ts)
