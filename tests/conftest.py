import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline import fixed  # noqa: E402
from ledgerline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
CANON = list(fixed.CANONICAL_NAMES.values())


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def lines_df(spark, rows, columns=None):
    """Invoice lines with every canonical column as text (or only ``columns``),
    plus document_id and row_ord. Missing keys are NULL."""
    cols = columns or CANON
    schema = ", ".join([f"`{c}` string" for c in cols] + ["document_id string", "row_ord long"])
    data = []
    for i, r in enumerate(rows):
        data.append(tuple(r.get(c) for c in cols) + (r.get("document_id", "DOC-1"), r.get("row_ord", i)))
    return spark.createDataFrame(data, schema)


def base_row(**kw):
    r = {
        "billing_account_number": "5-ABC", "charge_description": "Plain Port", "charge_amount": "10",
        "discount_amount": "0", "invoice_date": "2023-01-17", "bill_from_date": "2023-01-01",
        "bill_to_date": "2023-01-31", "units": "1", "charge_type": "Recurring", "service_id": "SVC-1",
        "currency": "USD",
    }
    r.update(kw)
    return r
