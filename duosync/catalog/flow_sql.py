"""SQL the flow queries are compared with.

A legacy-side flow is written as a set of patches with a ``kind``; ``merged`` then works out,
per key and column, which patch wins when they are applied in ``seq`` order.
"""

from __future__ import annotations

from duosync.catalog import flow_queries as Q
from duosync.catalog import standins as S
from duosync.catalog.operator_queries import NOW
from duosync.catalog.operator_sql import PIVOT
from duosync.catalog.standins import in_sql

_MD = [
    *[f"mdamount{i}" for i in (1, 2, 3)],
    *[f"md{i}_status" for i in (1, 2, 3)],
    *[f"md{i}_created_timestamp" for i in (1, 2, 3)],
]
_KEYS = ["legacy_customer_id", "routing_number", "account_number"]
_VALUES = [
    "account_id", "credit_account_id", "account_type", "result", "agent", "channel",
    "verification_type", "verified_date", *_MD, "locked", "verification_attempts",
    "change_timestamp", "created_by", "created_timestamp", "updated_by", "updated_timestamp",
    "is_primary",
]
_STAMPS = ["updated_timestamp", "change_timestamp"]
_UPSERT = [c for c in _VALUES if c not in ("created_by", "created_timestamp")]

# Columns each kind of patch sets on a present row, and fills when it inserts.
_UPDATES = {
    "upsert": _UPSERT,
    "account_insert": [c for c in _UPSERT if c != "account_id"],
    "account_upsert": [c for c in _UPSERT if c not in ("account_id", "credit_account_id")],
    "account_patch": ["is_primary", "account_type", *_STAMPS],
    "account_delete": ["result", *_STAMPS],
    "tombstone": ["result", "updated_by", *_STAMPS],
    "refresh": [
        "result", "agent", "channel", "verification_type", "verified_date", "md1_status",
        "md2_status", "md3_status", "locked", "verification_attempts", "updated_by", *_STAMPS,
    ],
    "attempt": ["locked", "verification_attempts"],
    "statuses": ["md1_status", "md2_status", "md3_status"],
}
_INSERTS = {
    "upsert": _VALUES,
    "account_insert": _VALUES,
    "account_upsert": _VALUES,
    "tombstone": [c for c in _VALUES if c not in (*_MD, "locked", "verification_attempts")],
}


def _in(col: str, sets: dict[str, list[str]]) -> str:
    kinds = [k for k, cols in sets.items() if col in cols]
    return "kind IN (" + ", ".join(f"'{k}'" for k in kinds or ["none"]) + ")"


_CAN_INSERT = "kind IN (" + ", ".join(f"'{k}'" for k in _INSERTS) + ")"
_TARGET_COLS = ["account_type", "result", "locked", "verification_attempts", "is_primary"]
_TYPES = {
    **dict.fromkeys(_VALUES, "VARCHAR"),
    **dict.fromkeys(["account_id", "credit_account_id"], "BIGINT"),
    **dict.fromkeys(["verification_attempts", "is_primary"], "INTEGER"),
    **dict.fromkeys(["mdamount1", "mdamount2", "mdamount3"], "DOUBLE"),
    **{c: "TIMESTAMP" for c in _VALUES if c.endswith(("_timestamp", "_date"))},
}


def merged(ctes: str, patches: str) -> str:
    """The target after the patches."""
    key = ", ".join(_KEYS)
    target = ", ".join(
        c if c in _TARGET_COLS else f"CAST(NULL AS {_TYPES[c]}) AS {c}" for c in _VALUES
    )
    folds, picks = [], []
    for c in _VALUES:
        upd = f"(present OR seq > fi) AND {_in(c, _UPDATES)}"
        first = f"NOT present AND seq = fi AND {_in(c, _INSERTS)}"
        folds.append(f"arg_max({{'v': {c}}}, seq) FILTER ({upd} OR {first}) AS w_{c}")
        picks.append(
            f"CASE WHEN w_{c} IS NULL THEN t.{c} ELSE CAST(w_{c}.v AS {_TYPES[c]}) END AS {c}"
        )
    keyless = ", ".join(
        f"CASE WHEN {_in(c, _INSERTS)} THEN CAST({c} AS {_TYPES[c]}) END AS {c}" for c in _VALUES
    )
    full = " AND ".join(f"{k} IS NOT NULL" for k in _KEYS)
    on_t = " AND ".join(f"t.{k} = p.{k}" for k in _KEYS)
    return f"""
WITH {ctes},
tgt AS (SELECT {key}, {target} FROM ({in_sql(Q.TARGET)}) x),
patches AS ({patches}),
known AS (SELECT p.*, t.legacy_customer_id IS NOT NULL AS present,
    min(seq) FILTER ({_CAN_INSERT}) OVER (PARTITION BY {', '.join('p.' + k for k in _KEYS)}) AS fi
  FROM patches p LEFT JOIN tgt t ON {on_t}
  WHERE {' AND '.join(f'p.{k} IS NOT NULL' for k in _KEYS)}),
folded AS (SELECT {key}, bool_or(present) AS present, min(fi) AS fi, {', '.join(folds)}
  FROM known GROUP BY {key})
SELECT {', '.join(f'coalesce(t.{k}, p.{k}) AS {k}' for k in _KEYS)}, {', '.join(picks)}
FROM tgt t FULL JOIN folded p ON {on_t}
WHERE t.legacy_customer_id IS NOT NULL OR fi IS NOT NULL
UNION ALL
SELECT {key}, {keyless} FROM patches WHERE NOT ({full}) AND {_CAN_INSERT}
"""


_LOCAL = f"((TIMESTAMP '{NOW}' AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles')"
_CHANGED = f"({_LOCAL} + INTERVAL 11 MICROSECONDS)"
_SYSTEM = f"TIMESTAMP '{NOW}'"


def base(after: bool = False) -> str:
    """Common tables. ``after`` is for all feeds in one batch: attempts count as of each
    verification event, and accounts have two phases, before (0) and after (1) their own event."""
    tried = "OR event_type = 'error' AND e.event_id * 4 + 2 < l.ver_id * 4 + 1" if after else ""
    stored = f"SELECT customer_id, is_primary, {{phase}} AS phase FROM ({in_sql(Q.CUSTOMER_ACCOUNT)}) c"
    owned = stored.format(phase=0)
    if after:
        owned += f""" UNION ALL SELECT customer_id, is_primary, 1
            FROM ({in_sql(S.ACCOUNT)}) a WHERE segment <> 'BUILDING'
          UNION ALL SELECT customer_id, is_primary, 1
            FROM ({in_sql(Q.CUSTOMER_ACCOUNT)}) c WHERE customer_bank_account_id >= 50000000"""
    else:
        owned += " UNION ALL " + stored.format(phase=1)
    return f"""
ver AS ({in_sql(Q.VERIFICATION)}),
acc AS ({in_sql(Q.DATED)}),
piv AS ({PIVOT}),
lockrow AS (SELECT id AS lock_id, bank_account_verification_id AS ver_id
  FROM ({in_sql(Q.LOCK)}) l),
clicks AS (SELECT l.lock_id, l.ver_id, count(*) AS n FROM lockrow l
  JOIN events e ON e.user_id = l.lock_id WHERE event_type = 'click' {tried}
  GROUP BY l.lock_id, l.ver_id),
stored_clicks AS (SELECT user_id, count(*) AS n FROM events
  WHERE event_type = 'click' GROUP BY user_id),
owned AS (SELECT customer_id, phase, count(*) AS n_accounts,
    CASE WHEN count(*) = 1 THEN min(is_primary) END AS account_primary
  FROM ({owned}) o GROUP BY customer_id, phase)
"""


def _classified(strict: bool, alias: str = "v") -> tuple[str, str]:
    v = f"{alias}."
    ok = f"{v}result = 'Pass'" + ("" if strict else f" OR {v}verified_date IS NOT NULL")
    ews = f"{v}verification_type IN ('Initial', 'Ews') AND {v}result = 'Pass'"
    status = f"""CASE WHEN {ews} THEN 'ACTIVE'
      WHEN {v}verification_type = 'MicroDeposit' AND ({ok}) THEN 'ACTIVE'
      WHEN {v}verification_type = 'Yodlee' AND {v}result = 'Pass' THEN 'ACTIVE'
      WHEN {v}verification_type IN ('MicroDeposit', 'Yodlee') THEN 'PENDING_ACH_VALIDATION' END"""
    code = f"""CASE WHEN {ews} THEN 'EWS' WHEN {v}verification_type = 'MicroDeposit'
      THEN 'MICRODEPOSIT' WHEN {v}verification_type = 'Yodlee' THEN 'YODLEE' END"""
    return status, code


def _select(values: dict[str, str]) -> str:
    cols = [*_KEYS, "seq", "kind", *_VALUES]
    return ", ".join(f"{values.get(c, f'CAST(NULL AS {_TYPES.get(c)})')} AS {c}" for c in cols)


_PIV = {c: f"pv.{c}" for c in _MD}


def customer_patches() -> str:
    status, code = _classified(strict=True)
    legacy = "v.is_migrated <> 2"
    other = f"({legacy}) IS NOT TRUE"
    wanted = "segment IN ('MACHINERY', 'FURNITURE')"
    mine = "nation >= 5"
    gone = "segment = 'BUILDING'"
    kind = f"""CASE WHEN segment = 'AUTOMOBILE' AND {legacy} THEN 'account_insert'
      WHEN {wanted} AND {legacy} THEN 'account_patch'
      WHEN {wanted} AND {other} AND {mine} THEN 'account_upsert'
      WHEN {gone} AND {legacy} THEN 'account_delete'
      WHEN {gone} AND {other} AND {mine} THEN 'tombstone' END"""
    values = {
        "legacy_customer_id": "CASE WHEN e.ver_id IS NOT NULL THEN customer_id END",
        "routing_number": "routing_number",
        "account_number": "account_number",
        "seq": "customer_id * 4",
        "kind": "kind",
        "account_id": "v_bank",
        "credit_account_id": "v_credit",
        "account_type": "short_type",
        "result": f"CASE WHEN {gone} THEN 'INACTIVE' ELSE status END",
        "agent": "agent",
        "channel": "channel",
        "verification_type": f"CASE WHEN {gone} THEN vtype ELSE code END",
        "verified_date": f"CASE WHEN {gone} OR code IS NOT NULL THEN verified_date END",
        **_PIV,
        "locked": "CASE WHEN l.lock_id IS NOT NULL THEN 'Y' ELSE 'N' END",
        "verification_attempts": "0",
        "change_timestamp": _CHANGED,
        "created_by": "agent",
        "created_timestamp": "v_created",
        "updated_by": "agent",
        "updated_timestamp": _LOCAL,
        "is_primary": "is_primary",
    }
    return f"""SELECT {_select(values)} FROM (
      SELECT a.*, v.bank_account_verification_id AS ver_id, v.bank_account_id AS v_bank,
        v.credit_account_id AS v_credit, v.agent, v.channel, v.verification_type AS vtype,
        v.verified_date, v.created_date AS v_created, {status} AS status, {code} AS code,
        {kind} AS kind
      FROM acc a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY bank_account_id,
            CAST(created_date AS DATE) ORDER BY created_date DESC,
            bank_account_verification_id DESC) AS rn FROM ver
          WHERE result = 'Pass' OR (verification_type = 'MicroDeposit' AND result IS NULL)) v
        ON rn = 1 AND v.bank_account_id = a.customer_id
          AND CAST(v.created_date AS DATE) = CAST(a.day AS DATE)
      ) e LEFT JOIN piv pv ON pv.bank_account_verification_id = e.ver_id
      LEFT JOIN lockrow l ON l.ver_id = e.ver_id
    WHERE kind IS NOT NULL"""


def customer_log() -> str:
    old_type = "CASE WHEN segment = 'MACHINERY' THEN 3 - type_id ELSE type_id END"

    def short(t):
        return f"CASE WHEN {t} = 1 THEN 'CHK' ELSE 'SAV' END"

    old_flag = "CASE WHEN segment = 'FURNITURE' THEN 1 - is_primary ELSE is_primary END"
    head = "'Inside Update and operation v_is_migrated = 2 | ABA: ' || "
    full = f"""{head} routing_number || ' | Account: ' || account_number || ' | Credit Card No: '
      || coalesce(CAST(v_credit AS VARCHAR), '') || ' | is_primary_new: ' || is_primary
      || ' | is_primary_old: ' || ({old_flag}) || ' | account type new: ' || {short('type_id')}
      || ' | account type old: ' || {short(f'({old_type})')}
      || 'Flag:' || CASE WHEN nation < 5 THEN 'True' ELSE 'False' END"""
    # A delete has no new row.
    gone = f"""{head} '' || ' | Account: ' || '' || ' | Credit Card No: ' || ''
      || ' | is_primary_new: ' || '' || ' | is_primary_old: ' || ({old_flag})
      || ' | account type new: ' || 'SAV' || ' | account type old: ' || {short('type_id')}
      || 'Flag:' || 'False'"""
    return f"""WITH {base()}, e AS (
      SELECT a.*, v.is_migrated, v.credit_account_id AS v_credit
      FROM acc a LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY bank_account_id,
            CAST(created_date AS DATE) ORDER BY created_date DESC,
            bank_account_verification_id DESC) AS rn FROM ver
          WHERE result = 'Pass' OR (verification_type = 'MicroDeposit' AND result IS NULL)) v
        ON rn = 1 AND v.bank_account_id = a.customer_id
          AND CAST(v.created_date AS DATE) = CAST(a.day AS DATE)),
      r AS (SELECT *, CASE
        WHEN segment = 'AUTOMOBILE' AND is_migrated <> 2 THEN 'Inside Insert and operation'
        WHEN segment IN ('MACHINERY', 'FURNITURE') AND is_migrated <> 2
          THEN 'Inside Update and operation v_is_migrated != 2'
        WHEN segment IN ('MACHINERY', 'FURNITURE') THEN {full}
        WHEN segment = 'BUILDING' AND (is_migrated <> 2) IS NOT TRUE AND nation >= 5 THEN {gone}
        END AS failure_reason FROM e)
      SELECT 'customer_account:' || customer_id * 4 AS event_id, 'trace' AS kind,
        'customer_bank_account_id:' || CASE WHEN segment = 'BUILDING' THEN ''
          ELSE CAST(customer_id AS VARCHAR) END AS table_id,
        'FAILED' AS status, failure_reason, 0 AS failure_count
      FROM r WHERE failure_reason IS NOT NULL"""


_CHECKS = """ver v JOIN acc a ON a.customer_id = v.bank_account_id
  LEFT JOIN piv pv ON pv.bank_account_verification_id = v.bank_account_verification_id
  LEFT JOIN lockrow l ON l.ver_id = v.bank_account_verification_id
  LEFT JOIN owned o ON o.customer_id = a.customer_id
    AND o.phase = CAST(v.bank_account_verification_id * 4 + 1 > a.customer_id * 4 AS INTEGER)"""
_REFRESH = "(v.is_migrated <> 2 AND v.verification_type = 'MicroDeposit')"
_FINE = "coalesce(n_accounts, 0) <= 1"


def verification_patches() -> str:
    status, code = _classified(strict=False)
    key = "v.bank_account_verification_id"

    def pick(legacy: str, migrated: str) -> str:
        return f"CASE WHEN {_REFRESH} THEN {legacy} ELSE {migrated} END"

    values = {
        "legacy_customer_id": "a.customer_id",
        "routing_number": "a.routing_number",
        "account_number": "a.account_number",
        "seq": f"{key} * 4 + 1",
        "kind": f"CASE WHEN {_REFRESH} THEN 'refresh' ELSE 'upsert' END",
        "account_id": "v.bank_account_id",
        "credit_account_id": "v.credit_account_id",
        "account_type": "short_type",
        "result": pick(
            f"CASE WHEN v.verified_date IS NOT NULL THEN 'ACTIVE' ELSE 'OLD' || ({key} % 3) END",
            status,
        ),
        "agent": "v.agent",
        "channel": "v.channel",
        "verification_type": pick("upper(v.verification_type)", code),
        "verified_date": pick(
            "v.verified_date", f"CASE WHEN {code} IS NOT NULL THEN v.verified_date END"
        ),
        **_PIV,
        "locked": pick(
            "CASE WHEN l.lock_id IS NOT NULL THEN 'Y' ELSE 'N' END",
            "CASE WHEN c.n = 3 THEN 'Y' ELSE 'N' END",
        ),
        "verification_attempts": pick("c.n", "coalesce(c.n, 0)"),
        "change_timestamp": pick(_SYSTEM, _CHANGED),
        "created_by": "v.agent",
        "created_timestamp": "v.created_date",
        "updated_by": "v.agent",
        "updated_timestamp": pick(_SYSTEM, _LOCAL),
        "is_primary": "account_primary",
    }
    return f"""SELECT {_select(values)} FROM {_CHECKS} LEFT JOIN clicks c ON c.lock_id = l.lock_id AND c.ver_id = l.ver_id
      WHERE {_FINE} AND ({_REFRESH} OR (v.is_migrated = 2 AND {key} % 5 <> 0))"""


VERIFICATION_LOG = f"""WITH {base()}
SELECT 'verification:' || v.bank_account_verification_id * 4 + 1 AS event_id,
  CASE WHEN {_FINE} THEN 'trace' ELSE 'reject' END AS kind,
  'Bank_Account_Verification_Id:' || v.bank_account_verification_id AS table_id,
  'FAILED' AS status,
  CASE WHEN {_FINE} THEN ' | ABA: ' || routing_number || ' | Account: ' || account_number
      || ' | Credit Card No: ' || v.credit_account_id || 'account type ' || short_type
      || 'Staging ' || CASE WHEN segment = 'HOUSEHOLD' THEN 'ACTIVE' ELSE '' END
    ELSE 'AMBIGUOUS_CUSTOMER_ACCOUNT' END AS failure_reason,
  1 AS failure_count
FROM {_CHECKS}
WHERE NOT ({_FINE}) OR {_REFRESH} IS NOT TRUE
""".replace("'verification:' || v.bank_account_verification_id * 4 + 1",
            "'verification:' || (v.bank_account_verification_id * 4 + 1)")


def attempt_patches() -> str:
    status, code = _classified(strict=False)
    prior = "CASE WHEN v.bank_account_verification_id IS NOT NULL THEN e.prior END"
    values = {
        "legacy_customer_id": "a.customer_id",
        "routing_number": "a.routing_number",
        "account_number": "a.account_number",
        "seq": "e.event_id * 4 + 2",
        "kind": "CASE WHEN v.is_migrated <> 2 THEN 'attempt' ELSE 'upsert' END",
        "account_id": "v.bank_account_id",
        "credit_account_id": "v.credit_account_id",
        "account_type": "short_type",
        "result": status,
        "agent": "v.agent",
        "channel": "v.channel",
        "verification_type": code,
        "verified_date": "v.verified_date",
        **_PIV,
        "locked": f"CASE WHEN ({prior}) = 2 THEN 'Y' ELSE 'N' END",
        "verification_attempts": f"coalesce({prior}, 0) + 1",
        "change_timestamp": _CHANGED,
        "created_by": "v.agent",
        "created_timestamp": "v.created_date",
        "updated_by": "v.agent",
        "updated_timestamp": _LOCAL,
        "is_primary": "account_primary",
    }
    return f"""SELECT {_select(values)} FROM (
        SELECT x.*, coalesce(s.n, 0) - 1 + count(*) OVER (PARTITION BY x.user_id ORDER BY event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prior
        FROM events x LEFT JOIN stored_clicks s ON s.user_id = x.user_id
        WHERE event_type = 'error') e
      LEFT JOIN lockrow l ON l.lock_id = e.user_id
      LEFT JOIN ver v ON v.bank_account_verification_id = l.ver_id
      LEFT JOIN acc a ON a.customer_id = v.bank_account_id
      LEFT JOIN piv pv ON pv.bank_account_verification_id = v.bank_account_verification_id
      LEFT JOIN owned o ON o.customer_id = a.customer_id
        AND o.phase = CAST(e.event_id * 4 + 2 > a.customer_id * 4 AS INTEGER)
      WHERE {_FINE} AND (v.is_migrated <> 2 OR ((v.is_migrated <> 2) IS NOT TRUE
        AND value > 5 AND value <= 60 AND event_id % 7 <> 0))"""


def transaction_patches() -> str:
    values = {
        "legacy_customer_id": "a.customer_id",
        "routing_number": "a.routing_number",
        "account_number": "a.account_number",
        "seq": "t.id * 4 + 3",
        "kind": "'statuses'",
        **{f"md{i}_status": "t.next_status" for i in (1, 2, 3)},
    }
    return f"""SELECT {_select(values)} FROM ({in_sql(S.TXN)}) t
      JOIN ver v ON v.bank_account_verification_id = t.bank_account_verification_id
      JOIN acc a ON a.customer_id = v.bank_account_id
      WHERE accounting_transaction_type = 'Debit' AND status <> next_status
        AND v.is_migrated <> 2"""


_STATUS, _CODE = _classified(strict=False)
ACCOUNT_STATUS = f"""
WITH v AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY created_date DESC, id DESC)
    AS rn FROM ({in_sql(S.VER)}) x),
p AS ({PIVOT}),
t AS (SELECT user_id, count(*) AS attempts FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT c_custkey AS account, c_name, id AS bank_account_verification_id, {_STATUS} AS result_new,
  {_CODE} AS verification_type_new,
  CASE WHEN {_CODE} IS NOT NULL THEN v.verified_date END AS verified_date_new,
  mdamount1, mdamount2, mdamount3, md1_status, md2_status, md3_status, attempts,
  CASE WHEN attempts = 3 THEN 'Y' ELSE 'N' END AS locked
FROM customer LEFT JOIN v ON account = c_custkey AND rn = 1
LEFT JOIN p ON p.bank_account_verification_id = v.id LEFT JOIN t ON user_id = c_custkey
"""

# ------------------------------------------------------------------------------- modern side


def _new_id(slot: int) -> str:
    """Id of a row generated by the event of order ``n``."""
    return f"-(n * 32 + {slot + 1})"


EVENTS = f"""
ev AS (SELECT e.*, CAST(old_account_type = 'CHK' AS INTEGER) AS old_chk,
    c_name AS holder, n_name AS bank_name,
    single_use <> '1' AS usable
  FROM ({in_sql(Q.MODERN_EVENT)}) e
  JOIN customer ON c_custkey = customer_id JOIN nation ON n_nationkey = c_nationkey),
started AS (SELECT bank_account_verification_id AS ver_id, verified_date AS ver_date,
    work_case_id AS ver_case FROM ({in_sql(Q.STARTED)}) s),
act AS (SELECT ev.*, ver_id, ver_date, ver_case,
    op = 'I' AND usable AS registers,
    op = 'I' AND usable AND (verification_type IS NULL AND result = 'PENDING_ACH_VERIFICATION'
      OR coalesce(verification_type = 'AGENT' AND result = 'ACTIVE', false)) AS steps_up,
    (op = 'I' AND usable AND result = 'ACTIVE')
      OR (o_orderstatus = 'P' AND priority = '1') AS opens,
    o_orderstatus = 'P' AND priority = '2' AS is_verify,
    o_orderstatus = 'F' AND priority = '1' AS retypes,
    operation_type = 'DELETE' AS removes,
    (o_orderstatus = 'P' AND priority = '3')
      OR (op = 'I' AND usable AND result = 'ACTIVE' AND new_primary = 1) AS promotes
  FROM ev LEFT JOIN started ON ver_id = n
    AND o_orderstatus = 'P' AND priority = '2')
"""

FLOW_ACCOUNT = f"""
WITH {EVENTS},
rows_after AS (
  SELECT n, n AS customer_bank_account_id, customer_id, account_number,
    CASE WHEN retypes THEN type_id WHEN old_chk = 1 THEN 1 ELSE 2 END AS account_type_id,
    -1 AS born FROM act WHERE is_stored AND NOT removes
  UNION ALL
  SELECT n, {_new_id(8)}, customer_id, account_number, type_id, n FROM act WHERE opens),
won AS (SELECT customer_id, max(n) AS last FROM act WHERE promotes GROUP BY customer_id)
SELECT customer_bank_account_id, r.customer_id, account_number, account_type_id,
  CASE WHEN born <= last AND n = last THEN 1 ELSE 0 END AS is_primary
FROM rows_after r LEFT JOIN won w ON w.customer_id = r.customer_id
"""


def _lines(cond: str, uc: str, texts: list[str]) -> str:
    case = " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts, 1))
    numbers = ", ".join(f"({i})" for i in range(1, len(texts) + 1))
    return f"""SELECT {uc} AS uc_id, line_no, CASE line_no {case} END AS data
      FROM act, (VALUES {numbers}) x(line_no) WHERE {cond}"""


_LAST4 = "'Verification on account ending in: ' || right(account_number, 4)"
_BANK = """'Bank Information Updated, ' || bank_name || ', ' || routing_number || ', '
  || account_number || ', ' || account_type"""
FLOW_ACCOUNT_AUDIT = f"""
WITH {EVENTS}
{_lines('steps_up', _new_id(2), ["'WORK CASE CREATED, STATUS OPEN'", _LAST4,
    "'Verification Method: Ews'",
    "CASE WHEN result = 'ACTIVE' THEN 'Verification Status: Successful' "
    "ELSE 'Verification Status:  Failed' END", "'STATUS CHANGED TO RCLOSED'"])}
UNION ALL
{_lines('opens OR retypes OR removes', _new_id(4), ["'USE CASE CREATED, STATUS OPEN'", _BANK,
    "'STATUS CHANGED TO RCLOSED'"]).replace("opens OR retypes OR removes",
    "opens OR retypes OR (removes AND is_stored)")}
UNION ALL
{_lines('is_verify AND ver_id IS NOT NULL AND ver_date IS NULL', 'ver_case',
    ["'Verification Status Update: Successful'", "'Verification Platform: UCRM'",
     "'STATUS CHANGED TO RCLOSED '"])}
"""
_USER = f"""CASE WHEN customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000)
  THEN customer_id ELSE -(min(n) OVER (PARTITION BY customer_id) * 32 + 1) END"""
FLOW_ACCOUNT_VERIFICATION = f"""
WITH {EVENTS}, u AS (SELECT *, {_USER} AS user_id FROM act)
SELECT {_new_id(7)} AS bank_account_verification_id,
  CASE WHEN verification_type IS NULL AND result = 'NEW' THEN 'Initial'
    WHEN verification_type = 'MICRODEPOSIT' THEN 'UnKnown' ELSE 'Ews' END AS verification_type,
  o_orderdate + INTERVAL 11 MICROSECONDS AS created_date,
  CASE WHEN verification_type = 'AGENT' THEN o_orderdate END AS verified_date,
  CASE WHEN steps_up THEN {_new_id(2)} END AS work_case_id, 'C1' AS agent,
  CASE WHEN n % 3 = 0 THEN 'Web' ELSE 'CASH' END AS channel,
  CASE WHEN verification_type IS NULL THEN 'StepUp' ELSE 'Pass' END AS result,
  credit_account_id, 2 AS is_migrated, {_new_id(1)} AS bank_account_id, user_id
FROM u WHERE registers
UNION ALL
SELECT {_new_id(6)}, 'Initial', o_orderdate, NULL, NULL, 'C1',
  CASE WHEN n % 3 = 0 THEN 'Web' ELSE 'CASH' END, 'StepUp', credit_account_id, 2,
  {_new_id(1)}, user_id FROM u WHERE steps_up
"""
FLOW_ACCOUNT_OUTBOX = f"""
WITH {EVENTS}
SELECT 'modern_account:' || n AS event_id,
  CASE WHEN op = 'I' THEN {_new_id(8)} ELSE n END AS customer_bank_account_id, customer_id,
  3 AS change_type FROM act WHERE promotes
UNION ALL SELECT 'modern_account:' || n, n, customer_id, 0 FROM act WHERE retypes
"""
FLOW_ACCOUNT_LOG = f"""
WITH {EVENTS}
SELECT 'modern_account:' || n AS event_id, 'trace' AS kind, CAST(n AS VARCHAR) AS table_id,
  'INFO' AS status, 'Account number or routing number change in update flow' AS failure_reason,
  0 AS failure_count FROM act WHERE o_orderstatus = 'P' AND priority = '4'
UNION ALL SELECT 'modern_account:' || n, 'trace', 'STAGE_SEQUENCE_ID:' || n, 'FAILED',
  'v_customer_bank_account_id:' || n, 0 FROM act WHERE removes
UNION ALL SELECT 'modern_account:' || n, 'reject', 'STAGE_SEQUENCE_ID:' || n, 'FAILED',
  'NO_MATCHING_VERIFICATION', 0 FROM act WHERE is_verify AND ver_id IS NULL
"""
FLOW_ACCOUNT_USERS = """
SELECT -(min(o_orderkey) * 32 + 1) AS id, o_custkey AS individual_identifier,
  min(c_name) AS individual_name
FROM orders JOIN customer ON c_custkey = o_custkey WHERE NOT c_acctbal >= 3000 GROUP BY o_custkey
"""

_CHANNEL = "CASE WHEN n % 3 = 0 THEN 'Web' ELSE 'CASH' END"
FLOW_ACCOUNT_CASES = f"""
WITH {EVENTS}
SELECT {_new_id(2)} AS uc_id, 1 AS status_id,
  CASE WHEN result = 'ACTIVE' THEN 415471 ELSE 415472 END AS type_id,
  'modern_account:' || n AS ref_num, o_orderdate AS open_date, 'C1' AS open_agent_id,
  o_orderdate + INTERVAL 1 DAY AS status_date, 'U1' AS status_agent_id, credit_account_id,
  customer_id AS card_id
FROM act WHERE steps_up
UNION ALL
SELECT {_new_id(4)}, 1, 325470, 'modern_account:' || n,
  CASE WHEN op = 'I' THEN o_orderdate ELSE o_orderdate + INTERVAL 1 DAY END,
  CASE WHEN op = 'I' THEN 'C1' ELSE 'U1' END, o_orderdate + INTERVAL 1 DAY, 'U1',
  credit_account_id, customer_id
FROM act WHERE opens OR retypes OR (removes AND is_stored)
"""
FLOW_ACCOUNT_HISTORY = f"""
WITH {EVENTS}, h AS (
  SELECT *, 1 AS change_code FROM act WHERE opens
  UNION ALL SELECT *, 3 FROM act WHERE promotes AND op = 'U'
  UNION ALL SELECT *, 3 FROM act WHERE retypes
  UNION ALL SELECT *, 2 FROM act WHERE removes AND is_stored)
SELECT 'modern_account:' || n AS event_id, customer_id, change_code, account_number,
  routing_number, type_id AS account_type_id, {_CHANNEL} AS channel FROM h
"""
FLOW_ACCOUNT_ID_MAP = f"""
WITH {EVENTS}
SELECT n AS modern_bank_account_id, {_new_id(1)} AS legacy_bank_account_id,
  'TRIGGER' AS created_by FROM act WHERE registers
"""
FLOW_ACCOUNT_BANKS = f"""
WITH {EVENTS}
SELECT {_new_id(1)} AS id, routing_number AS aba_number, account_number,
  bank_type AS account_type FROM act WHERE op = 'I'
"""
FLOW_ACCOUNT_VERIFIED = f"""
WITH {EVENTS}
SELECT ver_id AS bank_account_verification_id, o_orderdate + INTERVAL 1 DAY AS verified_date,
  'Pass' AS result FROM act WHERE is_verify AND ver_id IS NOT NULL AND ver_date IS NULL
"""

_DEPOSIT_CHANNEL = "CASE WHEN n % 3 = 0 THEN 'Web' ELSE 'AGENT' END"
DEPOSITS = f"""
dep AS (SELECT o.*, s.bank_account_verification_id IS NOT NULL AS found, work_case_id,
    o_orderstatus = 'O' AND priority <= '3' AS starts, o_orderstatus <> 'O' AS updates,
    CAST(0.11 AS DOUBLE) + n % 7 AS amount1,
    CASE WHEN n % 9 <> 0 THEN CAST(0.25 AS DOUBLE) END AS amount2
  FROM ({in_sql(S.ORDER_ACCOUNT)}) o LEFT JOIN ({in_sql(Q.STARTED)}) s
    ON s.bank_account_verification_id = n)
"""
FLOW_DEPOSIT = f"""
WITH {DEPOSITS}
SELECT id, t.bank_account_verification_id, accounting_transaction_type, amount,
  CASE WHEN d.n IS NULL THEN status ELSE 'Processed' END AS status,
  d.o_orderdate + INTERVAL 2 DAY AS post_date
FROM ({in_sql(S.TXN)}) t LEFT JOIN dep d ON d.n = t.bank_account_verification_id
  AND updates AND found AND priority = '1'
UNION ALL
SELECT -(n * 32 + CASE line WHEN 1 THEN 14 WHEN 2 THEN 13 ELSE 12 END), {_new_id(7)},
  CASE line WHEN 3 THEN 'Debit' ELSE 'Credit' END,
  CASE line WHEN 1 THEN amount1 WHEN 2 THEN amount2 ELSE amount1 + amount2 END,
  'Received', o_orderdate + INTERVAL 2 DAY
FROM dep, (VALUES (1), (2), (3)) x(line) WHERE starts
"""
FLOW_DEPOSIT_AUDIT = f"""
WITH {DEPOSITS}, act AS (SELECT * FROM dep)
{_lines('starts', _new_id(2), ["'WORK CASE CREATED, STATUS OPEN'", _LAST4,
    "'Verification Status Update: In Progress'", "'STATUS CHANGED TO PEND'"])}
UNION ALL
{_lines("updates AND found AND priority IN ('3', '4')", 'work_case_id',
    ["'Verification Status Update: Failed'", "'Verification Platform: UCRM'",
     "'Status changed to PENDING'"])}
UNION ALL
{_lines("updates AND found AND priority = '4'", 'work_case_id',
    ["'Verification Status Update: ERROR'", "'STATUS CHANGED TO ERRCLOSED'"])}
"""
FLOW_DEPOSIT_ATTEMPTS = f"""
WITH {DEPOSITS}
SELECT {_new_id(10)} AS id,
  CASE WHEN o_orderstatus = 'F' THEN n ELSE {_new_id(9)} END AS verification_locking_id,
  o_orderdate + INTERVAL 2 DAY AS created_date, '640' AS agent, 'Web' AS channel
FROM dep WHERE updates AND found AND priority IN ('3', '4')
"""
FLOW_DEPOSIT_CASES = f"""
WITH {DEPOSITS}
SELECT {_new_id(2)} AS uc_id, 26 AS status_id, 415470 AS type_id,
  'modern_deposit:' || n AS ref_num, o_orderdate AS open_date, '1' AS open_agent_id,
  o_orderdate + INTERVAL 2 DAY AS status_date, '1' AS status_agent_id, credit_account_id,
  customer_id AS card_id
FROM dep WHERE starts
"""
FLOW_DEPOSIT_VERIFICATIONS = f"""
WITH {DEPOSITS}
SELECT {_new_id(7)} AS bank_account_verification_id, 'MicroDeposit' AS verification_type,
  o_orderdate AS created_date, {_new_id(2)} AS work_case_id, '640' AS agent,
  {_DEPOSIT_CHANNEL} AS channel, 2 AS is_migrated, credit_account_id FROM dep WHERE starts
"""
FLOW_DEPOSIT_CHECKS = f"""
WITH {DEPOSITS}
SELECT n AS bank_account_verification_id,
  CASE WHEN updates AND priority = '1' THEN o_orderdate + INTERVAL 2 DAY END AS ach_posted_date,
  CASE WHEN updates AND priority = '2' THEN o_orderdate + INTERVAL 2 DAY END AS canceled_date,
  '640' AS verification_agent, 'Web' AS verification_channel
FROM dep WHERE found
UNION ALL
SELECT {_new_id(7)}, NULL, NULL, '1', {_DEPOSIT_CHANNEL} FROM dep WHERE starts
"""
FLOW_DEPOSIT_LOCKS = f"""
WITH {DEPOSITS}
SELECT {_new_id(9)} AS id, o_orderdate + INTERVAL 2 DAY AS open_date,
  n AS bank_account_verification_id
FROM dep WHERE updates AND found AND priority IN ('3', '4') AND o_orderstatus <> 'F'
"""
FLOW_DEPOSIT_ID_MAP = f"""
WITH {DEPOSITS}
SELECT n AS modern_bank_account_id, n + 7000000 AS modern_micro_deposit_id,
  {_new_id(7)} AS legacy_micro_deposit_id FROM dep WHERE starts
"""
FLOW_DEPOSIT_LOG = f"""
WITH {DEPOSITS}
SELECT 'modern_deposit:' || n AS event_id, 'reject' AS kind, 'STAGE_SEQUENCE_ID:' || n AS table_id,
  'FAILED' AS status, 'Bank Account Verification Id is Null' AS failure_reason, 1 AS failure_count
FROM dep WHERE updates AND NOT found
"""

_ALL = " UNION ALL ".join(
    [customer_patches(), verification_patches(), attempt_patches(), transaction_patches()]
)
FLOW_SQL = {
    "account_status": ACCOUNT_STATUS,
    "flow_customer": merged(base(), customer_patches()),
    "flow_customer_log": customer_log(),
    "flow_verification": merged(base(), verification_patches()),
    "flow_verification_log": VERIFICATION_LOG,
    "flow_attempt": merged(base(), attempt_patches()),
    "flow_transaction": merged(base(), transaction_patches()),
    "flow_account": FLOW_ACCOUNT,
    "flow_account_audit": FLOW_ACCOUNT_AUDIT,
    "flow_account_verification": FLOW_ACCOUNT_VERIFICATION,
    "flow_account_outbox": FLOW_ACCOUNT_OUTBOX,
    "flow_account_log": FLOW_ACCOUNT_LOG,
    "flow_account_users": FLOW_ACCOUNT_USERS,
    "flow_account_cases": FLOW_ACCOUNT_CASES,
    "flow_account_history": FLOW_ACCOUNT_HISTORY,
    "flow_account_id_map": FLOW_ACCOUNT_ID_MAP,
    "flow_account_banks": FLOW_ACCOUNT_BANKS,
    "flow_account_verified": FLOW_ACCOUNT_VERIFIED,
    "flow_deposit": FLOW_DEPOSIT,
    "flow_deposit_cases": FLOW_DEPOSIT_CASES,
    "flow_deposit_verifications": FLOW_DEPOSIT_VERIFICATIONS,
    "flow_deposit_checks": FLOW_DEPOSIT_CHECKS,
    "flow_deposit_locks": FLOW_DEPOSIT_LOCKS,
    "flow_deposit_id_map": FLOW_DEPOSIT_ID_MAP,
    "flow_deposit_audit": FLOW_DEPOSIT_AUDIT,
    "flow_deposit_attempts": FLOW_DEPOSIT_ATTEMPTS,
    "flow_deposit_log": FLOW_DEPOSIT_LOG,
    "run_batch": merged(base(after=True), _ALL),
    "run_stream": merged(base(after=True), _ALL),
}
