"""Fixed values of the audit model, stated once.

Readers of the audit logs and the reporting views compare with these texts, so they
are data, not wording to improve.
"""

from __future__ import annotations

# --- fixed values: statuses -------------------------------------------------------
YES, NO = "Yes", "No"
FULL, WATERMARK = "FULL", "WATERMARK"
RUNNING, SUCCESS, FAILURE, PARTIAL_SUCCESS = "RUNNING", "SUCCESS", "FAILURE", "PARTIAL_SUCCESS"
PENDING, APPROVED, REJECTED = "PENDING", "APPROVED", "REJECTED"
PASS, WARNING, FAIL = "PASS", "WARNING", "FAIL"
INITIAL_LOAD, OLD_PROJECTION_SAFE, BREAKING = "INITIAL_LOAD", "OLD_PROJECTION_SAFE", "BREAKING"
TABLE_SUCCESS, SCHEMA_CHANGE, TABLE_FAILURE = "TABLE_SUCCESS", "SCHEMA_CHANGE", "TABLE_FAILURE"
GATE_1, GATE_2 = "GATE_1_PRE_PUBLISH", "GATE_2_POST_PUBLISH"

# --- fixed values: check names and details ----------------------------------------
SOURCE_STAGE_ROW_COUNT = "SOURCE_STAGE_ROW_COUNT"
DUPLICATE_PRIMARY_KEY = "DUPLICATE_PRIMARY_KEY"
NULL_PRIMARY_KEY = "NULL_PRIMARY_KEY"
APPROVED_SCHEMA = "APPROVED_SCHEMA"
STAGE_KEYS_PUBLISHED = "STAGE_KEYS_PUBLISHED"
FULL_ROW_COUNT = "FULL_ROW_COUNT"
DETAILS = {
    (GATE_1, SOURCE_STAGE_ROW_COUNT): "Source load window equals approved-column staging rows.",
    (GATE_1, DUPLICATE_PRIMARY_KEY): "Stage key uniqueness.",
    (GATE_1, NULL_PRIMARY_KEY): "Stage key completeness.",
    (GATE_1, APPROVED_SCHEMA): "Approved source columns present.",
    (GATE_2, STAGE_KEYS_PUBLISHED): "Each staged key appears in curated.",
    (GATE_2, DUPLICATE_PRIMARY_KEY): "Curated key uniqueness.",
    (GATE_2, NULL_PRIMARY_KEY): "Curated key completeness.",
    (GATE_2, FULL_ROW_COUNT): "Full curated count equals staging.",
}
MISSING_COLUMN_DETAIL = (
    "Previously approved column missing or renamed; old projection cannot be loaded safely."
)

# --- fixed values: report labels --------------------------------------------------
GATE_LABELS = {
    GATE_1: "Gate 1 - Source vs Dev/Test",
    GATE_2: "Gate 2 - Dev/Test vs Integ/Prod",
}
SKIPPED_LABEL = "Skipped (Load = No)"

# --- fixed values: request and notification texts ---------------------------------
INITIAL_SUMMARY = "Initial approved source schema established for first load."
INITIAL_NOTES = "Prototype baseline approval."
CHANGE_SUMMARY = (
    "Source schema differs from the last approved version. Prototype requires human approval."
)
SUCCESS_MESSAGE = "Table load and reconciliation succeeded."
CHANGE_MESSAGE = "Schema change recorded; load completed with the previously approved columns."
CHANGE_FAILURE_MESSAGE = (
    "Source schema change status {status}; previously approved projection could not be loaded: {error}"
)

# --- fixed values: error codes ----------------------------------------------------
ERRORS = {
    50001: "Decision must be APPROVED or REJECTED.",
    50002: "Schema change request not found.",
    50003: "Only PENDING requests can be decided.",
    50010: "Configuration row not found.",
    50011: "Configuration row is not enabled.",
    50012: "Configured source table does not exist.",
    50013: "Previously approved column is missing or renamed; old projection cannot be loaded safely.",
    50014: "Gate 1 reconciliation failed; curated data was not touched.",
    50015: "Gate 2 reconciliation failed; curated publish was rolled back.",
    50020: (
        "One or more configured table loads failed. "
        "Review audit.PipelineRunAudit and audit.TableLoadAudit."
    ),
    51001: "No enabled configurations.",
    51002: "No disabled configuration for exclusion demo.",
    51003: "Invalid watermark configuration.",
    52001: "No pending schema-change request found.",
    52002: "No pending schema-change request found.",
}


class LoadError(Exception):
    """A contract error; ``code`` is one of ERRORS or None for other failures."""

    def __init__(self, code: int | None, message: str | None = None):
        super().__init__(message or ERRORS[code])
        self.code = code

TIME_LIMIT_MESSAGE = "The attempt exceeded its time limit of {seconds:g} seconds."
