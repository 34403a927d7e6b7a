"""Fixed values of the invoice contract.

Everything in this module must equal the behaviour being reproduced for the
results to be right: column names of the input contract, the sheet layout,
the description markers, the status messages and the dropped-column list.
They are stated once, plainly and in their natural order; the operators
import them from here.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: input contract (CSV header text -> canonical column name)
# ---------------------------------------------------------------------------

# Required columns, in contract order (the first five are the original
# contract; the two bill dates were read unguarded and are required here).
REQUIRED_COLUMNS = [
    "Billing Account Number",
    "Charge Description",
    "Charge Amount",
    "Discount Amount",
    "Invoice Date",
    "Bill To Date",
    "Bill From Date",
]

# Optional columns and their default when the column is absent from a file.
OPTIONAL_COLUMNS = [
    "Units",
    "Charge Type Description",
    "Service Number",
    "Bill Invoice Number",
    "Account Description 1",
    "Bus Org ID",
    "Internal Account Number",
    "Legacy* Circuit Id",
    "Product Family",
    "Service ID (Supporting ID)",
    "Product Line",
    "Install Date",
    "Carrier Circuit ID",
    "PIID-Product",
    "Service Line (Customer Service)",
    "Service Address A",
    "Location A City",
    "Location A State",
    "Location A Country",
    "Service Address B",
    "Location Z City",
    "Location Z State",
    "Location Z Country",
    "Currency",
]
OPTIONAL_DEFAULTS = {"Currency": "USD"}  # every other optional column: ''

# Header text -> canonical name. Headers are matched exactly first, then
# case-insensitively (the optional list spells "Bus Org Id").
CANONICAL_NAMES = {
    "Billing Account Number": "billing_account_number",
    "Charge Description": "charge_description",
    "Charge Amount": "charge_amount",
    "Discount Amount": "discount_amount",
    "Invoice Date": "invoice_date",
    "Bill To Date": "bill_to_date",
    "Bill From Date": "bill_from_date",
    "Units": "units",
    "Charge Type Description": "charge_type",
    "Service Number": "service_number",
    "Bill Invoice Number": "bill_invoice_number",
    "Account Description 1": "account_description_1",
    "Bus Org ID": "bus_org_id",
    "Internal Account Number": "internal_account_number",
    "Legacy* Circuit Id": "legacy_circuit_id",
    "Product Family": "product_family",
    "Service ID (Supporting ID)": "service_id",
    "Product Line": "product_line",
    "Install Date": "install_date",
    "Carrier Circuit ID": "carrier_circuit_id",
    "PIID-Product": "piid_product",
    "Service Line (Customer Service)": "service_line",
    "Service Address A": "service_address_a",
    "Location A City": "location_a_city",
    "Location A State": "location_a_state",
    "Location A Country": "location_a_country",
    "Service Address B": "service_address_b",
    "Location Z City": "location_z_city",
    "Location Z State": "location_z_state",
    "Location Z Country": "location_z_country",
    "Currency": "currency",
}

# Cell texts read as missing (the CSV reader's default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: charge-description markers, in branch order (first match wins)
# ---------------------------------------------------------------------------
MARK_CUSTOMER_REF = " Customer Reference ID: "
MARK_CIRCUIT = "-Circuit ID: "
MARK_CIRCUIT_SPACED = "- Circuit ID: "
MARK_TOLL_FREE_SPACED = "- Toll Free: "
MARK_TOLL_FREE = "-Toll Free: "
MARK_TN_FEE = "TN Fee - "
MARK_WHITE_PAGES = "Business White Pages Listing "

# One-time charge types removed before de-duplication (exact, case-sensitive).
ONE_TIME_CHARGE_TYPES = ["Non-Recurring", "NON-RECURRING"]

# Product lines left out of the filtered copy.
EXCLUDED_PRODUCT_LINES = ["HSIP", "Level 3 Dedicated Internet Access", "Wavelength"]

# Characters removed from money text, and from units text before parsing.
# (?U): white space as Unicode has it, so that a no-break space goes too.
MONEY_STRIP_PATTERN = r"(?U)[\s$(),]"
UNITS_STRIP_PATTERN = r"(?U)[-\s;,:_()\/]"

# Stand-in date for a missing "Bill To Date" while ordering.
BILL_TO_SENTINEL = "1900-01-01"

# Date formats tried in order when text becomes a date or timestamp.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy", "M/d/yyyy H:mm"]

# Layouts that a document's date column may have when its layout is inferred. The order decides between layouts that fit
# all of a column: month first before day first.
INFERRED_FORMATS = [
    "yyyy-M-d", "yyyy-M-d H:mm:ss", "yyyy-M-d H:mm", "yyyy-M-d'T'H:mm:ss", "yyyy/M/d", "yyyyMMdd",
    "M/d/yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "d/M/yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm",
    "M-d-yyyy", "d-M-yyyy", "M.d.yyyy", "d.M.yyyy", "d-MMM-yyyy", "d MMM yyyy", "MMM d, yyyy", "MMM d yyyy",
]

# Run stamp layout in the sheet preamble.
STAMP_FORMAT = "dd-MMM-yyyy HH:mm:ss"

# ---------------------------------------------------------------------------
# FIXED VALUES: document status texts
# ---------------------------------------------------------------------------
MSG_NOT_AT_SOURCE = "File not found in Source folder. Skipping."
MSG_ALREADY_DONE = "File already exists in Destination folder. Skipping"
MSG_MISSING_SUFFIX = " are missing."
MSG_EMPTY_FILE = "Empty file. No rows found. Being ignored."
MSG_EMPTY_AFTER_RULES = "After applying all the rules file found as empty."
STATUS_ERROR = "Error"
STATUS_SUCCESS = "Success"
RUN_SUMMARY = "EOF"

# ---------------------------------------------------------------------------
# FIXED VALUES: upload sheet
# ---------------------------------------------------------------------------
SHEET_TITLE = "Service Upload Sheet"
SHEET_USER_LABEL = "User: "
SHEET_BLANK_CELL = " "

# The 40 sheet columns in order: (display header, canonical column).
# "{p}" is the vendor column prefix (a job parameter).
SHEET_COLUMNS = [
    (" ", "blank"),
    ("Vendor (Purchasing)", "vendor"),
    ("Account Identifier", "account_identifier"),
    ("Product Name", "product_name"),
    ("Service Quantity", "service_quantity"),
    ("Unit Recurring Cost", "unit_recurring_cost"),
    ("Billing Frequency", "billing_frequency"),
    ("Unit Non-Recurring Cost", "unit_non_recurring_cost"),
    ("Currency", "currency"),
    ("Service Start Date", "service_start_date"),
    ("Service Term", "service_term"),
    ("Service End Date", "service_end_date"),
    ("Service Identifier", "service_identifier"),
    ("Location A", "location_a"),
    ("Location B", "location_b"),
    ("Email of M3 Owner", "owner_email"),
    ("Service Owner", "service_owner"),
    ("Order Number", "order_number"),
    ("Order Date", "order_date"),
    ("DocID", "doc_id"),
    ("{p} - A Location Name", "a_location_name"),
    ("{p} - Alternate ID", "alternate_id"),
    ("{p} - Bill Invoice Number", "vendor_bill_invoice_number"),
    ("{p} - Customer Name", "customer_name"),
    ("{p} - Customer Number", "customer_number"),
    ("{p} - Data Source", "data_source"),
    ("{p} - Internal Account Number", "vendor_internal_account_number"),
    ("{p} - Legacy Circuit ID", "vendor_legacy_circuit_id"),
    ("{p} - Product Family", "vendor_product_family"),
    ("{p} - Product Identifier (PIID) [Parent]", "piid_parent"),
    ("{p} - Product Line", "vendor_product_line"),
    ("{p} - Service Component Name", "service_component_name"),
    ("{p} - Service Line", "vendor_service_line"),
    ("{p} - Status", "vendor_status"),
    ("{p} - VPN ID", "vpn_id"),
    ("{p} - Z Location Name", "z_location_name"),
    ("{p}-Custom:Toll Free Number", "toll_free_number"),
    ("Latest - Extraction Date", "extraction_date"),
    ("Latest - Invoice #", "latest_invoice_number"),
    ("Latest - DOC-ID", "latest_doc_id"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: columns dropped before the sheet projection (absent ones are
# ignored). Header texts, in their original order.
# ---------------------------------------------------------------------------
DROPPED_COLUMNS = [
    "Billing Account Number", "Product Family", "Annotation", "Charge Level", "Charge Type Description", "Product",
    "Service Line (Customer Service)", "Product Line", "Location A City", "Location A State", "Location A Country",
    "Location Z City", "Location Z State", "Location Z Country", "Market/Tier Name", "Rate Center",
    "Service ID (Supporting ID)", "Charge Description", "Additional Charge Information", "Bill From Date",
    "Bill To Date", "Units", "Charge Amount", "Discount Amount", "Tax: Federal", "Tax: State", "Tax: City",
    "Tax: County", "Tax: Other", "Tax: VAT", "Account Description 1", "Account Description 2",
    "Bill Invoice Number", "Bill Invoice Row ID", "Billing Account Number-Account Description 1-Service ID",
    "Bus Org ID", "Carrier Circuit ID", "Carrier ID", "Child Account, Name", "Circuit ID", "Circuit Information",
    "Circuit Type", "Circuit_ID_A", "Circuit_ID_Z", "CLIN / BPID Code", "CLIN /BPID Description", "CLLIA", "CLLIZ",
    "Contract Number", "Customer Designated Codes", "Day of Month", "Day of Week", "Digital Access",
    "Disconnect Date", "Discount Description", "Display Account Number", "Effective Date", "End User",
    "Event Date", "Event Time", "Hour", "Install Date", "Internal Account Number", "Invoice Date",
    "Invoice Section Name", "IP_Address", "Jurisdiction", "Legacy* Circuit Id", "Legacy* Circuit Term",
    "Legacy* IP VPN PIID", "Legacy* Logical Interface PIID", "Legacy* Port Id", "Legacy* Service End User",
    "Legacy* Service ID", "Location A Type", "Location Z", "Location Z Type", "Managed Service Type", "Member ID",
    "Month", "NPA_NXX", "PIID-Product", "PO Number", "POP Units", "Port Code", "Product Account Name",
    "Provisioning Circuit ID", "PSCID - Service", "Quarter", "Rate", "SCID-GLMPS (MM)", "SCID-Service",
    "Seat Price", "Seat Quantity", "Section Header 2", "Service Address A", "Service Address B",
    "Service Description 1", "Service Description 2", "Service Number", "Service Order", "Service Provider",
    "Service Request", "Service Type", "Site Name", "Site Number", "Speed", "Star", "Subsection Header",
    "Switch ID Location A", "Switch ID Location Z", "Switch Name Location A", "Switch Name Location Z",
    "Tariff/Period", "Tax Included (Y/N)", "Tax Label", "TM", "TM, WEB, VDE, STAR, Annotation", "Unit Number",
    "Unit Rate", "V&H Miles", "VDE", "Web", "Week", "WTN", "Year", "Revised Unit Cost", "Custom:Toll Free Number",
]

# ---------------------------------------------------------------------------
# Error codes (stable texts in place of a traceback), with their stage order:
# the first stage that fails decides a document's error.
# ---------------------------------------------------------------------------
ERR_ROW_TOO_LONG = "ROW_LONGER_THAN_HEADER"
ERR_DESCRIPTION_MISSING = "DESCRIPTION_MISSING"
ERR_MARKER_ORDER = "CIRCUIT_AFTER_CUSTOMER_REFERENCE"
ERR_LISTING_WITHOUT_DASH = "LISTING_WITHOUT_DASH"
ERR_INVOICE_DATE = "INVOICE_DATE_UNPARSEABLE"
ERR_CHARGE_AMOUNT = "CHARGE_AMOUNT_NOT_NUMERIC"
ERR_DISCOUNT_AMOUNT = "DISCOUNT_AMOUNT_NOT_NUMERIC"

STAGE_ROW_SHAPE = 0
STAGE_DESCRIPTION = 1
STAGE_INVOICE_DATE = 2
STAGE_CHARGE_AMOUNT = 3
STAGE_DISCOUNT_AMOUNT = 4
