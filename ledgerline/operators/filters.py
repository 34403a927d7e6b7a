"""Row and document filters (null-safe, pushed into the scan where possible)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed


def is_one_time(col: str = "charge_type"):
    return F.coalesce(F.col(col).isin(*fixed.ONE_TIME_CHARGE_TYPES), F.lit(False))


def drop_one_time(df: DataFrame, col: str = "charge_type") -> DataFrame:
    """remove rows whose charge type is exactly one of the one-time texts;
    other spellings, blank and missing are kept."""
    return df.filter(~is_one_time(col))


def exclude_product_lines(df: DataFrame, col: str = "product_line",
                          values: Sequence[str] = tuple(fixed.EXCLUDED_PRODUCT_LINES)) -> DataFrame:
    """keep rows whose product line is none of ``values``; missing kept."""
    return df.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def eligible(df: DataFrame, col: str = "error") -> DataFrame:
    """documents with no error text set."""
    return df.filter(F.coalesce(F.col(col), F.lit("")) == "")
