"""Explicit schemas of the change feeds, facts, dimensions, target and outputs."""

from __future__ import annotations

import re

from pyspark.sql import types as T

MONEY = "decimal(18,2)"
_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    MONEY: T.DecimalType(18, 2),
}


def schema(ddl: str) -> T.StructType:
    """The struct of a "name type, name type" text; needs no session, so imports may use it."""
    fields = re.findall(r"(\w+)\s+(\w+(?:\(\d+,\d+\))?)", ddl)
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


MODERN_ACCOUNT = """
    stage_sequence_id long, modern_bank_account_id long, legacy_customer_id long,
    credit_account_id long, routing_number string, account_number string, account_type string,
    single_use string, operation_type string, verification_type string, result string,
    verified_date timestamp, channel string, is_primary int, created_by string,
    created_timestamp timestamp, updated_by string, updated_timestamp timestamp
"""
MODERN_DEPOSIT = f"""
    stage_sequence_id long, md_id long, modern_bank_account_id long, legacy_customer_id long,
    routing_number string, account_number string, account_type string, md_status string,
    mdamount1 {MONEY}, mdamount2 {MONEY}, verification_attempts int, locked string,
    channel string, created_timestamp timestamp, updated_timestamp timestamp
"""
CUSTOMER_ACCOUNT = """
    customer_bank_account_id long, customer_id long, routing_number string,
    account_number string, account_type_id int, is_primary int, created_date timestamp
"""
VERIFICATION = """
    bank_account_verification_id long, verification_type string, created_date timestamp,
    verified_date timestamp, work_case_id long, agent string, channel string, result string,
    credit_account_id long, is_migrated int, bank_account_id long, user_id long
"""
ATTEMPT = """
    id long, verification_locking_id long, created_date timestamp, agent string, channel string
"""
TRANSACTION = f"""
    id long, created_date timestamp, post_date timestamp, amount {MONEY},
    accounting_transaction_type string, status string, status_update_date timestamp,
    ach_transaction_id long, bank_account_verification_id long,
    bank_account_verification_id_old long
"""
TARGET = f"""
    legacy_customer_id long, account_id long, credit_account_id long, routing_number string,
    account_number string, account_type string, result string, agent string, channel string,
    verification_type string, verified_date timestamp,
    mdamount1 {MONEY}, mdamount2 {MONEY}, mdamount3 {MONEY},
    md1_status string, md2_status string, md3_status string,
    md1_created_timestamp timestamp, md2_created_timestamp timestamp,
    md3_created_timestamp timestamp,
    locked string, verification_attempts int, change_timestamp timestamp, created_by string,
    created_timestamp timestamp, updated_by string, updated_timestamp timestamp, is_primary int
"""
BANK_ACCOUNT = "id long, aba_number string, account_number string, account_type string"
USER = """
    id long, individual_identifier long, identifier_type int, individual_name string, id_old long
"""
CREDIT_ACCOUNT = "credit_account_id long, customer_id long"
CARD = "card_id long, credit_account_id long, current_card int"
HOLDER = "customer_id long, credit_account_id long, name_id long"
NAME = "name_id long, name string"
BANK_DIRECTORY = "rt_micr string, rt_instit string"
LOCK = "id long, open_date timestamp, bank_account_verification_id long"
DEPOSIT_VERIFICATION = """
    canceled_date timestamp, ach_posted_date timestamp, verification_agent string,
    verification_channel string, bank_account_verification_id long,
    bank_account_verification_id_old long
"""
WORK_CASE = """
    status_id int, type_id int, ref_num string, open_date timestamp, open_agent_id string,
    status_date timestamp, status_agent_id string, uc_id long, credit_account_id long,
    card_id long
"""
AUDIT = """
    uc_audit_id long, agent_id int, data string, audit_date timestamp, uc_id long, line_no int
"""
OUTBOX = "event_id string, customer_bank_account_id long, customer_id long, change_type int"
HISTORY = """
    event_id string, customer_id long, change_code int, account_number string,
    routing_number string, account_type_id int, channel string
"""
ID_MAP = """
    modern_bank_account_id long, legacy_bank_account_id long, created_by string,
    created_timestamp timestamp, modern_micro_deposit_id long, legacy_micro_deposit_id long
"""
# The last event whose image a source row took, also of rows that are deleted since.
APPLIED = "feed string, row_id long, seq long"
LOG = """
    event_id string, kind string, trigger_name string, table_name string, table_id string,
    source_system string, destination_system string, status string, failure_reason string,
    failure_count int, created_by string, created_timestamp timestamp, updated_by string,
    updated_timestamp timestamp, domain string, trigger_input string
"""

# Change feeds by flow.
FEEDS = {
    "modern_account": MODERN_ACCOUNT,
    "modern_deposit": MODERN_DEPOSIT,
    "customer_account": CUSTOMER_ACCOUNT,
    "verification": VERIFICATION,
    "attempt": ATTEMPT,
    "transaction": TRANSACTION,
}

# Tables the flows read and keep.
TABLES = {
    "modern_account": MODERN_ACCOUNT,
    "modern_deposit": MODERN_DEPOSIT,
    "customer_account": CUSTOMER_ACCOUNT,
    "verification": VERIFICATION,
    "attempt": ATTEMPT,
    "transaction": TRANSACTION,
    "bank_account": BANK_ACCOUNT,
    "user": USER,
    "credit_account": CREDIT_ACCOUNT,
    "card": CARD,
    "holder": HOLDER,
    "name": NAME,
    "bank_directory": BANK_DIRECTORY,
    "lock": LOCK,
    "deposit_verification": DEPOSIT_VERIFICATION,
    "id_map": ID_MAP,
    "applied": APPLIED,
    "target": TARGET,
}

# Insert-only outputs.
OUTPUTS = {
    "case": WORK_CASE,
    "audit": AUDIT,
    "outbox": OUTBOX,
    "history": HISTORY,
    "log": LOG,
}

# What the modern-side flows return beside their outputs.
ACCOUNT_RESULT = {
    "user": USER,
    "bank_account": BANK_ACCOUNT,
    "case": WORK_CASE,
    "audit": AUDIT,
    "verification": VERIFICATION,
    "verification_patch": """
        bank_account_verification_id long, verified_date timestamp, result string, seq long,
        event_id string
    """,
    "history": HISTORY,
    "outbox": OUTBOX,
    "id_map": ID_MAP,
    "log": LOG,
    "account_opened": f"{CUSTOMER_ACCOUNT}, seq long",
    "account_retyped": "customer_bank_account_id long, account_type_id int, seq long",
    "account_removed": "customer_bank_account_id long, seq long",
    "promotion": "event_id string, customer_id long, account_id long, seq long",
}
DEPOSIT_RESULT = {
    "case": WORK_CASE,
    "audit": AUDIT,
    "verification": VERIFICATION,
    "deposit_verification": DEPOSIT_VERIFICATION,
    "transaction": TRANSACTION,
    "id_map_patch": """
        modern_bank_account_id long, modern_micro_deposit_id long, legacy_micro_deposit_id long,
        seq long
    """,
    "posting": "bank_account_verification_id long, ach_posted_date timestamp, seq long",
    "cancelling": "bank_account_verification_id long, canceled_date timestamp",
    "lock": LOCK,
    "attempt": ATTEMPT,
    "log": LOG,
}


def envelope(row_ddl: str) -> T.StructType:
    """Schema of a change feed whose images have the given columns."""
    row = schema(row_ddl)
    return T.StructType(
        [
            T.StructField("event_id", T.StringType()),
            T.StructField("seq", T.LongType()),
            T.StructField("op", T.StringType()),
            T.StructField("origin", T.StringType()),
            T.StructField("updated_cols", T.ArrayType(T.StringType())),
            T.StructField("before", row),
            T.StructField("after", row),
        ]
    )
