"""Canonical column names, schemas and the fixed values the work-queue uses.

Internally every table uses snake_case names. Exported sheets carry the
human headers listed in ``EXPORT_HEADERS``; ``sources.rename_to_canonical``
maps them at ingest.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()

# --- Fixed values (must equal the source work-queue's for identical results) ---
# Export header -> canonical column.
EXPORT_HEADERS = {
    "Client Name": "client_name",
    "Client ID Number": "client_id",
    "Date/Time": "date_time",
    "Staff Member(s)": "staff",
    "Status": "status",
    "Service Type": "service_type",
    "Is Billed": "is_billed",
    "Client Id": "client_id",
    "Primary Insurance: Provider Name": "payor",
    "Payor Name": "payor_name",
    "Exceptions": "exceptions",
    "Active/Archived": "active_archived",
    "Transaction Number": "transaction_number",
    "Transaction Status": "transaction_status",
    "First Name": "first_name",
    "Last Name": "last_name",
    "DOB": "dob",
    "Gender": "gender",
    "Street": "street",
    "City": "city",
    "State": "state",
    "ZIP Code": "zip",
    "Claim Invoice Number": "claim_invoice_number",
    "Insurance Number": "insurance_number",
    "Place of Service": "place_of_service",
    "DX Code": "dx_code",
    "Charge Amount": "charge_amount",
    "Quantity": "quantity",
}
# Headers of the provider masters, the remittance work-list and the ledger.
PROVIDER_HEADERS = {
    "Payer": "payer",
    "Staff Members": "staff",
    "Rendering Provider": "rendering_provider",
    "Billing Provider": "billing_provider",
    "Availity Rendering Provider": "portal_rendering_provider",
    "Availity Billing Provider": "portal_billing_provider",
}
WORKLIST_HEADERS = {
    "Availity Login": "login",
    "State Name": "state_name",
    "RSMs": "rsm",
    "Practice Name": "practice",
    "Status": "wl_status",
}
LEDGER_HEADERS = {
    "Check/EFT": "check_no",
    "Payer": "payer",
    "Payee": "payee",
    "Check Date": "check_date",
    "Check/EFT Amount": "amount",
    "Status": "status",
    "RSM": "rsm",
}
# Ragged rule-sheet columns -> rule name.
RULE_COLUMNS = {
    "Status": "exclude_status",
    "No Show CPT's": "no_show_cpts",
    "Late Cancel CPT's": "late_cancel_cpts",
    "Kept CPT's": "kept_cpts",
    "Availity Payors": "private_payor",
    "Exception Client ID": "exception_client",
    "Staff Member payors": "staff_payor",
}
# Rule columns that hold integer procedure codes.
CODE_RULES = ("no_show_cpts", "late_cancel_cpts", "kept_cpts")
# Appointment statuses and the procedure-code rule that gates each.
NO_SHOW = "No Show"
LATE_CANCEL = "Late Cancel"
KEPT = "Kept"
GATED_STATUS_RULE = {NO_SHOW: "no_show_cpts", LATE_CANCEL: "late_cancel_cpts",
                     KEPT: "kept_cpts"}
CANCEL_STATUSES = (LATE_CANCEL, NO_SHOW)
SELF_PAY = "Self Pay"
YES = "Yes"
# Payor spellings recoded to one label.
PAYOR_RECODE_FROM = ("United Healthcare", "UnitedHealthcare")
PAYOR_RECODE_TO = "Optum"
INACTIVE_MARK = "Inactive"
# Cancellation fee rule.
CANCEL_FEE = "65.00"
ZERO_AMOUNT = "0.00"
DEFAULT_UNITS = "1"
# Registry tabs, best first.
TABS = ("Active", "Archived")
# Exception texts, in the order the checks run.
EXC_CLIENT_NOT_FOUND = "Client Name or ID not found"
EXC_NO_SERVICE = "No claims are present in particular DOS"
EXC_NO_DX = "DX code not found"
EXC_AWAITING = "The claim encountered an error during the 'Awaiting Submission' process."
# (The source stops the run at a missing provider; here the case gets its own exception.)
EXC_NO_PROVIDER = "Provider not found in the master tables"
NO_DX_LABEL = "None of the Cases related to this session have billable diagnoses entered."
# Invoice note and the state it leaves.
INVOICE_NOTE_PREFIX = "Claim submitted through availity portal under the transaction ID#"
TXN_UPDATED = "Transaction Number updated"
# Remittance ledger statuses and work-list states.
FILE_DOWNLOADED = "File Downloaded"
FILE_NOT_DOWNLOADED = "File Not Downloaded"
WL_STATE_NOT_FOUND = "State Not found"
WL_PRACTICE_NOT_FOUND = "Practice name not found in Drop Down"
WL_NO_EOBS = "No EOBs for Cheque Date"
WL_PROCESSED = "Processed"
WL_UNMATCHED = "Unmatched"
# Characters removed from remittance names (colon, question mark, slash, pipe,
# apostrophe, star, angle brackets; not backslash, not double quote).
HOSTILE_CHARS = ":?/|'*<>"
# Claim form constants.
CLAIM_FREQUENCY = "1"
CLAIM_ASSIGNMENT = "A -"
CLAIM_RELEASE = "Y -"
CLAIM_SIGNATURE = "Yes"
# Text tokens read as missing by the CSV landing step (pandas defaults).
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
             "n/a", "nan", "null")
# --- end of fixed values ---


CLAIM_RECORD_COLS = (
    "client_name", "client_id", "date_time", "service_type", "staff", "payor_name",
    "first_name", "last_name", "dob", "gender", "street", "city", "state", "zip",
    "claim_invoice_number", "insurance_number", "place_of_service", "dx_code",
    "charge_amount", "quantity",
)

REMIT_LEDGER = T.StructType([
    T.StructField("check_no", S), T.StructField("payer", S), T.StructField("payee", S),
    T.StructField("check_date", S), T.StructField("amount", S),
    T.StructField("status", S), T.StructField("rsm", S),
])
