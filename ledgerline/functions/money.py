"""P5-P10: money text, units text, unit cost and service quantity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

# A plain decimal number (no '1d'/'1f' suffixes, which Spark's cast would
# otherwise accept). Two other spellings of Python's float() are left out on
# purpose: 'inf' / 'nan' are no amounts, and digit groups like '1_000' don't occur
# in amounts; both are reported as not numeric.
PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def guarded_double(text: Column) -> Column:
    """Text to double only when it is a plain number, else NULL."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast("double"))


def money_text(c: Column) -> Column:
    """P5 step 1: strip whitespace, '$', '(', ')' and ','."""
    return F.regexp_replace(c, fixed.MONEY_STRIP_PATTERN, "")


def money_value(c: Column, stripped: Column, paren_negative: bool = False) -> tuple[Column, Column]:
    """P5 step 2: (value, is_error) of money text ``c`` that is already ``stripped``.

    Parentheses do not negate unless ``paren_negative``. Missing stays NULL;
    non-missing text that is not a number afterwards is an error.
    """
    value = guarded_double(stripped)
    if paren_negative:
        value = F.when(c.contains("("), -value).otherwise(value)
    return value, c.isNotNull() & ~stripped.rlike(PLAIN_NUMBER)


def clean_money(c: Column, paren_negative: bool = False) -> tuple[Column, Column]:
    """P5: (value, is_error)."""
    return money_value(c, money_text(c), paren_negative)


def units_text(c: Column) -> Column:
    """Units as text; a plain number loses surrounding spaces, a leading '+'
    and leading zeros (as a numeric column would print it)."""
    trimmed = F.btrim(c, F.lit(" \t\r\n\u00a0"))
    canonical = F.regexp_replace(F.regexp_replace(trimmed, r"^\+", ""), r"^(-?)0+(\d)", "$1$2")
    return F.when(trimmed.rlike(PLAIN_NUMBER), canonical).otherwise(c)


def floor_units_text(text: Column) -> Column:
    """P6 on units text already canonical (``units_text``): text below '1' by
    *string* comparison becomes '1.00'; a missing cell is the text 'nan' (which
    is not below '1')."""
    t = F.coalesce(text, F.lit("nan"))
    return F.when(t < F.lit("1"), F.lit("1.00")).otherwise(t)


def floor_units(c: Column) -> Column:
    """P6."""
    return floor_units_text(units_text(c))


def units_strip(floored: Column) -> Column:
    """P7 step 1: remove - whitespace ; , : _ ( ) /."""
    return F.regexp_replace(floored, fixed.UNITS_STRIP_PATTERN, "")


def units_number(floored: Column) -> Column:
    """A number, else NULL."""
    return guarded_double(units_strip(floored))


def unit_cost(charge: Column, discount: Column, units: Column) -> Column:
    """(charge - discount) / units; NULL when units is 0 or missing."""
    return F.try_divide(charge - discount, units)


def round3(c: Column) -> Column:
    """Round half-even on the scaled float (rint), missing -> 0."""
    return F.coalesce(F.rint(c * F.lit(1000.0)) / F.lit(1000.0), F.lit(0.0))


def rounded_units(units: Column) -> Column:
    """P10 step 1: half-even rounded units, missing -> 0."""
    return F.rint(F.coalesce(units, F.lit(0.0))).try_cast("long")


def quantity_from_rounded(q: Column) -> Column:
    """P10 step 2: 0 -> 1."""
    return F.when(q == 0, F.lit(1).cast("long")).otherwise(q)


def service_quantity(units: Column) -> Column:
    """P10."""
    return quantity_from_rounded(rounded_units(units))


# The same rules with each intermediate value in a column of its own: a value
# used twice inside CASE branches is otherwise inlined and evaluated twice
# (subexpression elimination does not reach into conditional branches).

def with_units(df: DataFrame, col: str = "units", prefix: str = "_u") -> DataFrame:
    """P6 + P7 as staged columns: ``{prefix}_text`` (canonical text, the O3
    order), ``{prefix}_floored`` (P6) and ``{prefix}_num`` (P7); each regex runs
    once per row."""
    df = df.withColumn(f"{prefix}_text", units_text(F.col(col)))
    df = df.withColumn(f"{prefix}_floored", floor_units_text(F.col(f"{prefix}_text")))
    df = df.withColumn(f"{prefix}_strip", units_strip(F.col(f"{prefix}_floored")))
    return df.withColumn(f"{prefix}_num", guarded_double(F.col(f"{prefix}_strip"))).drop(f"{prefix}_strip")


def with_money(df: DataFrame, col: str, out: str, paren_negative: bool = False) -> DataFrame:
    """P5 as staged columns: ``out`` (value) and ``{out}_bad`` (error flag)."""
    df = df.withColumn(f"{out}_text", money_text(F.col(col)))
    value, bad = money_value(F.col(col), F.col(f"{out}_text"), paren_negative)
    return df.withColumns({out: value, f"{out}_bad": bad}).drop(f"{out}_text")
