"""A4: first non-missing value of each column per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A4: per group, each column's value on the first row (by ``order``) where
    it is not missing. ``min_by`` with a NULL ordering for missing values skips
    them; it is order-independent (unlike ``first``) and aggregates map-side."""
    cols = [c for c in (columns or df.columns) if c not in keys and c != order]
    return df.groupBy(*keys).agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )
