"""Split a free-text charge description into an identifier and a product name.

The branch is decided first (first matching marker wins), then one marker is
chosen per row and the text is split once with ``split_part`` (a literal
delimiter, so markers need no regex escaping). Everything stays a JVM
expression inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed

# Branch codes, in the order they are tested.
BRANCH_CIRCUIT_AND_CUSTOMER_REF = "a"
BRANCH_CUSTOMER_REF = "b"
BRANCH_CIRCUIT = "c"
BRANCH_CIRCUIT_SPACED = "d"
BRANCH_TOLL_FREE_SPACED = "e"
BRANCH_TOLL_FREE = "f"
BRANCH_TN_FEE = "g"
BRANCH_WHITE_PAGES = "h"
BRANCH_PLAIN = "i"


def description_branch(desc: Column) -> Column:
    has = lambda marker: desc.contains(marker)  # noqa: E731 - literal substring test
    return (
        F.when(desc.isNull(), F.lit(None).cast("string"))
        .when(has(fixed.MARK_CUSTOMER_REF) & has(fixed.MARK_CIRCUIT), BRANCH_CIRCUIT_AND_CUSTOMER_REF)
        .when(has(fixed.MARK_CUSTOMER_REF), BRANCH_CUSTOMER_REF)
        .when(has(fixed.MARK_CIRCUIT), BRANCH_CIRCUIT)
        .when(has(fixed.MARK_CIRCUIT_SPACED), BRANCH_CIRCUIT_SPACED)
        .when(has(fixed.MARK_TOLL_FREE_SPACED), BRANCH_TOLL_FREE_SPACED)
        .when(has(fixed.MARK_TOLL_FREE), BRANCH_TOLL_FREE)
        .when(has(fixed.MARK_TN_FEE), BRANCH_TN_FEE)
        .when(has(fixed.MARK_WHITE_PAGES), BRANCH_WHITE_PAGES)
        .otherwise(BRANCH_PLAIN)
    )


def _after_first(text: Column, first: Column, sep: str) -> Column:
    """Pieces after the first ``sep``-separated piece, joined with one space.

    ``substr`` past the end gives '' in both engines, so no branch for a text
    without ``sep`` is needed.
    """
    rest = F.substr(text, F.length(first) + F.lit(2))
    return rest if sep == " " else F.replace(rest, F.lit(sep), F.lit(" "))


def parse_charge_description(
    df: DataFrame,
    desc_col: str = "charge_description",
    id_col: str = "toll_free_number",
    name_col: str = "product_name",
    branch_col: str = "description_branch",
    error_col: str = "description_error",
) -> DataFrame:
    """Add identifier, product name, branch code and error code columns."""
    desc = F.col(desc_col)
    b = F.col(branch_col)
    staged = df.withColumn(branch_col, description_branch(desc))
    marker = (
        F.when(b.isin(BRANCH_CIRCUIT_AND_CUSTOMER_REF, BRANCH_CUSTOMER_REF), F.lit(fixed.MARK_CUSTOMER_REF))
        .when(b == BRANCH_CIRCUIT, F.lit(fixed.MARK_CIRCUIT))
        .when(b == BRANCH_CIRCUIT_SPACED, F.lit(fixed.MARK_CIRCUIT_SPACED))
        .when(b == BRANCH_TOLL_FREE_SPACED, F.lit(fixed.MARK_TOLL_FREE_SPACED))
        .when(b == BRANCH_TOLL_FREE, F.lit(fixed.MARK_TOLL_FREE))
        .otherwise(F.lit("-"))
    )
    staged = staged.withColumns(
        {
            "_d_head": F.split_part(desc, marker, F.lit(1)),
            "_d_tail": F.split_part(desc, marker, F.lit(2)),
        }
    )
    head, tail = F.col("_d_head"), F.col("_d_tail")
    # Identifier and remainder of the tail, split on '-' (a, b, e, f) or ' ' (c, d);
    # kept as columns because identifier and name both use them.
    staged = staged.withColumns({
        "_d_dash1": F.split_part(tail, F.lit("-"), F.lit(1)),
        "_d_space1": F.split_part(tail, F.lit(" "), F.lit(1)),
    })
    dash_first, space_first = F.col("_d_dash1"), F.col("_d_space1")
    dash_rest = _after_first(tail, dash_first, "-")
    space_rest = _after_first(tail, space_first, " ")
    circuit_head = F.split_part(head, F.lit(fixed.MARK_CIRCUIT), F.lit(1))
    circuit_ref = F.split_part(head, F.lit(fixed.MARK_CIRCUIT), F.lit(2))
    marker_order_bad = ~head.contains(fixed.MARK_CIRCUIT)
    no_dash = ~desc.contains("-")

    error = (
        F.when(desc.isNull(), F.lit(fixed.ERR_DESCRIPTION_MISSING))
        .when((b == BRANCH_CIRCUIT_AND_CUSTOMER_REF) & marker_order_bad, F.lit(fixed.ERR_MARKER_ORDER))
        .when((b == BRANCH_WHITE_PAGES) & no_dash, F.lit(fixed.ERR_LISTING_WITHOUT_DASH))
    )
    ident = (
        F.when(b == BRANCH_CIRCUIT_AND_CUSTOMER_REF, F.concat(dash_first, F.lit(" "), circuit_ref))
        .when(b.isin(BRANCH_CUSTOMER_REF, BRANCH_TOLL_FREE_SPACED, BRANCH_TOLL_FREE), dash_first)
        .when(b.isin(BRANCH_CIRCUIT, BRANCH_CIRCUIT_SPACED), space_first)
        .when(b.isin(BRANCH_TN_FEE, BRANCH_WHITE_PAGES), tail)
        .when(b == BRANCH_PLAIN, F.lit(""))
    )
    name = (
        F.when(b == BRANCH_CIRCUIT_AND_CUSTOMER_REF, F.concat(circuit_head, F.lit(" "), dash_rest))
        .when(b.isin(BRANCH_CUSTOMER_REF, BRANCH_TOLL_FREE_SPACED, BRANCH_TOLL_FREE), F.concat(head, F.lit(" "), dash_rest))
        .when(b.isin(BRANCH_CIRCUIT, BRANCH_CIRCUIT_SPACED), F.concat(head, F.lit(" "), space_rest))
        .when(b.isin(BRANCH_TN_FEE, BRANCH_WHITE_PAGES), head)
        .when(b == BRANCH_PLAIN, desc)
    )
    return staged.withColumns(
        {
            error_col: error,
            id_col: F.when(error.isNull(), ident),
            name_col: F.when(error.isNull(), name),
        }
    ).drop("_d_head", "_d_tail", "_d_dash1", "_d_space1")


def description_error(desc: Column, branch: Column | None = None) -> Column:
    """The P1 error code alone (no split of the text beyond the one test that
    needs it): for checks over every row when the identifier and product
    name are only needed for some rows. Pass ``branch`` when it is already a
    column, so the branch tests run once."""
    b = branch if branch is not None else description_branch(desc)
    head_cri = F.split_part(desc, F.lit(fixed.MARK_CUSTOMER_REF), F.lit(1))
    return (
        F.when(desc.isNull(), F.lit(fixed.ERR_DESCRIPTION_MISSING))
        .when((b == BRANCH_CIRCUIT_AND_CUSTOMER_REF) & ~head_cri.contains(fixed.MARK_CIRCUIT), F.lit(fixed.ERR_MARKER_ORDER))
        .when((b == BRANCH_WHITE_PAGES) & ~desc.contains("-"), F.lit(fixed.ERR_LISTING_WITHOUT_DASH))
    )
