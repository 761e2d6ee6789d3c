"""Code values shared with the two account systems.

Everything in this module is a fixed value: a code, label or text that must match
what the systems already store, so it is spelled out rather than computed.
"""

# Account type codings, as (checking, savings).
ACCOUNT_TYPE_CODINGS = {
    "short": ("CHK", "SAV"),
    "long": ("Checking", "Savings"),
    "id": (1, 2),
}

# Channel codes, modern -> legacy.
CHANNEL_CODES = {
    "AGENT": "CASH",
    "CAS": "CAS",
    "MOBILE": "Mobile_App",
    "WEB": "Web",
}

# Work case types and statuses.
CASE_EWS_ACTIVE = 415471
CASE_EWS_PENDING = 415472
CASE_MICRO_DEPOSIT = 415470
CASE_REGISTRATION = 325470
CASE_STATUS_OPEN = 1
CASE_STATUS_MICRO_DEPOSIT = 26

# Agents used when the event names none.
SYSTEM_AGENT = 1
MICRO_DEPOSIT_AGENT = "640"

# Verification rows.
MIGRATED = 2
USER_IDENTIFIER_TYPE = 2

# Outbox change types and account history codes.
OUTBOX_TYPE_CHANGE = 0
OUTBOX_PRIMARY = 3
HISTORY_INSERT = 1
HISTORY_DELETE = 2
HISTORY_UPDATE = 3

# Audit texts per template, in the order the lines are written.
# {last4}, {bank}, {routing}, {account}, {type} are filled from the event.
AUDIT_TEMPLATES = {
    "step_up_ok": [
        "WORK CASE CREATED, STATUS OPEN",
        "Verification on account ending in: {last4}",
        "Verification Method: Ews",
        "Verification Status: Successful",
        "STATUS CHANGED TO RCLOSED",
    ],
    "step_up_failed": [
        "WORK CASE CREATED, STATUS OPEN",
        "Verification on account ending in: {last4}",
        "Verification Method: Ews",
        "Verification Status:  Failed",
        "STATUS CHANGED TO RCLOSED",
    ],
    "registration": [
        "USE CASE CREATED, STATUS OPEN",
        "Bank Information Updated, {bank}, {routing}, {account}, {type}",
        "STATUS CHANGED TO RCLOSED",
    ],
    "verified": [
        "Verification Status Update: Successful",
        "Verification Platform: UCRM",
        "STATUS CHANGED TO RCLOSED ",
    ],
    "deposit_started": [
        "WORK CASE CREATED, STATUS OPEN",
        "Verification on account ending in: {last4}",
        "Verification Status Update: In Progress",
        "STATUS CHANGED TO PEND",
    ],
    "attempt_failed": [
        "Verification Status Update: Failed",
        "Verification Platform: UCRM",
        "Status changed to PENDING",
    ],
    "deposit_locked": [
        "Verification Status Update: ERROR",
        "STATUS CHANGED TO ERRCLOSED",
    ],
}

# Log rows: name of the writing flow, changed table, and prefix of the table id.
LOG_SOURCES = {
    "modern_account": (
        "TRIG_INS_STG_MDRN_EXT_BNK_ACCT",
        "STAGE_ACH_MODERN_EXT_BANK_ACCOUNT",
        "STAGE_SEQUENCE_ID:",
    ),
    "modern_deposit": (
        "TRIG_INS_STG_MDRN_MIC_DEP",
        "ODS_STG.STAGE_MODERN_MICRO_DEPOSIT",
        "STAGE_SEQUENCE_ID:",
    ),
    "customer_account": (
        "TRIG_INS_UPD_DEL_T_CUSTOMER_BANK_ACCOUNT",
        "T_CUSTOMER_BANK_ACCOUNT",
        "customer_bank_account_id:",
    ),
    "verification": (
        "TRIG_UPD_BAV_BANK_ACCOUNT_VERIFICATION",
        "T_BAV_BANK_ACCOUNT_VERIFICATION",
        "Bank_Account_Verification_Id:",
    ),
    "attempt": (
        "TRIG_INS_T_BAV_MD_VERIFICATION_ATTEMPT",
        "T_BAV_MD_VERIFICATION_ATTEMPT",
        "VERIFICATION_LOCKING_ID: ",
    ),
    "transaction": (
        "TRIG_UPD_T_BAV_MD_VERIFICATION_TRANSACTION",
        "T_BAV_MD_VERIFICATION_TRANSACTION",
        "Bank_Account_Verification_Id:",
    ),
}
LOG_DOMAIN = "EXTERNAL_ACCOUNTS"
LOG_CREATED_BY = "TRIGGER"

# Trace texts.
TRACE_INSERT = "Inside Insert and operation"
TRACE_UPDATE_LEGACY = "Inside Update and operation v_is_migrated != 2"
TRACE_UPDATE_MIGRATED = "Inside Update and operation v_is_migrated = 2"
TRACE_ROUTE_CHANGE = "Account number or routing number change in update flow"
TRACE_DELETE_CREATED_BY = "Before exception"
TRACE_DELETE_PREFIX = "v_customer_bank_account_id:"
REJECT_NO_VERIFICATION = "Bank Account Verification Id is Null"

# The texts before each value of a detailed trace.
CUSTOMER_ACCOUNT_TRACE = (
    " | ABA: ",
    " | Account: ",
    " | Credit Card No: ",
    " | is_primary_new: ",
    " | is_primary_old: ",
    " | account type new: ",
    " | account type old: ",
    "Flag:",
)
VERIFICATION_TRACE = (
    " | ABA: ",
    " | Account: ",
    " | Credit Card No: ",
    "account type ",
    "Staging ",
)
ATTEMPT_TRACE = ("Routing number",)
