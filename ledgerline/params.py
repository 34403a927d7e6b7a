"""Job parameters (the named arguments of a run), passed to operators."""

from __future__ import annotations

from dataclasses import dataclass

from . import fixed


@dataclass(frozen=True)
class JobParams:
    vendor: str = "Carrier"  # written to "Vendor (Purchasing)"
    column_prefix: str | None = None  # prefix of the vendor columns; defaults to `vendor`
    client_name: str = ""
    upload_user: str = ""
    default_owner_email: str = ""
    tenant_bridge_id: str = ""
    tenant_bridge_run_id: str = ""
    date_formats: tuple[str, ...] = tuple(fixed.DATE_FORMATS)
    # How date text is read: "formats" (each value by the first of ``date_formats`` that fits) or
    # "infer" (each document's column by the layout of ``inferred_formats`` that fits all of it).
    date_mode: str = "formats"
    inferred_formats: tuple[str, ...] = tuple(fixed.INFERRED_FORMATS)
    # Keep every row's errors (Normalized.rejects), not only a document's first.
    keep_rejects: bool = False
    # A run goes through its files in groups of about so many files and bytes (a larger file is a group's own).
    group_files: int = 20_000
    group_bytes: int = 2 << 40
    # W1 ordering of "Bill To Date": "parsed" (as a timestamp) or "raw" (as text).
    latest_order: str = "parsed"
    # Literal written for a missing Location B part.
    null_token: str = "nan"
    # Money in parentheses stays positive unless this is set.
    paren_negative: bool = False

    @property
    def prefix(self) -> str:
        return self.column_prefix if self.column_prefix is not None else self.vendor

    def sheet_headers(self) -> list[str]:
        return [name.replace("{p}", self.prefix) for name, _ in fixed.SHEET_COLUMNS]
