"""The column contract of an invoice document."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


def canonical(header: str) -> str | None:
    """Canonical column of a CSV header text: exact match, then case-insensitive."""
    if header in fixed.CANONICAL_NAMES:
        return fixed.CANONICAL_NAMES[header]
    lowered = {k.lower(): v for k, v in fixed.CANONICAL_NAMES.items()}
    return lowered.get(header.lower())


def optional_defaults() -> dict[str, str]:
    """Canonical optional column -> default text for an absent column."""
    return {canonical(h): fixed.OPTIONAL_DEFAULTS.get(h, "") for h in fixed.OPTIONAL_COLUMNS}


def drop_blank_rows(df: DataFrame, input_cols: Sequence[str]) -> DataFrame:
    """Drop rows where every input column is missing (bookkeeping columns
    such as document_id/row_ord are not part of the test)."""
    return df.na.drop(how="all", subset=list(input_cols))


def missing_required(header: Column, required: Sequence[str] = tuple(fixed.REQUIRED_COLUMNS)) -> Column:
    """Required header texts absent from ``header`` (array<string>), in contract order."""
    return F.array_except(F.array(*[F.lit(r) for r in required]), F.coalesce(header, F.array().cast("array<string>")))


def missing_required_message(missing: Column) -> Column:
    """C2: 'A, B,  are missing.' (each name followed by ', '), or NULL when none is missing."""
    return F.when(
        F.size(missing) > 0,
        F.concat(F.array_join(missing, ", "), F.lit(", "), F.lit(fixed.MSG_MISSING_SUFFIX)),
    )


def check_empty(docs: DataFrame, rows: DataFrame, key: str = "document_id") -> DataFrame:
    """Documents with no row left after C1 get the empty-file message.

    Rows are counted with a partial (map-side) aggregate, so a document that
    holds a large share of all rows costs one small record per map task.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    out = docs.join(counts, key, "left").withColumn("n_rows", F.coalesce(F.col("n_rows"), F.lit(0)))
    return out.withColumn("empty_error", F.when(F.col("n_rows") == 0, F.lit(fixed.MSG_EMPTY_FILE)))


def add_optional(df: DataFrame, defaults: dict[str, str] | None = None) -> DataFrame:
    """C4: add absent optional columns with their default ('' or 'USD').
    Blank cells of columns that exist are left as they are."""
    defaults = optional_defaults() if defaults is None else defaults
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def drop_columns(df: DataFrame, headers: Iterable[str] = tuple(fixed.DROPPED_COLUMNS)) -> DataFrame:
    """Drop the listed columns, by header text or its canonical name; absent ones are ignored."""
    names = set()
    for h in headers:
        names.add(h)
        c = canonical(h)
        if c:
            names.add(c)
    return df.drop(*[c for c in df.columns if c in names])


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed projection in the given order; absent names become empty (NULL) text columns."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])
