"""The SQL each operator query is compared with. Written for DuckDB, over whole tables."""

from __future__ import annotations

from duosync.catalog import standins as S
from duosync.catalog.operator_queries import CODED, NOW, ORIGIN
from duosync.catalog.standins import in_sql

VER, TXN, ATTEMPT = in_sql(S.VER), in_sql(S.TXN), in_sql(S.ATTEMPT)
ACCOUNT, TGT, SRC = in_sql(S.ACCOUNT), in_sql(S.TGT), in_sql(S.SRC)
RAW_DEPOSIT = in_sql(S.RAW_DEPOSIT).replace("AS STRING", "AS VARCHAR")

FEED = """
SELECT *, CASE WHEN prev_id IS NULL THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
FROM (
  SELECT event_id, user_id, ts, event_type, value, nullif(event_type, 'signup') AS kind,
    lag(event_id) OVER w AS prev_id, lag(event_type) OVER w AS prev_type,
    lag(value) OVER w AS prev_value, lag(nullif(event_type, 'signup')) OVER w AS prev_kind
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)
) e
"""

_LENIENT = "(result = 'Pass' OR verified_date IS NOT NULL)"


def _classify(deposit_ok: str, always: bool) -> str:
    date = "verified_date" if always else "CASE WHEN vt IS NOT NULL THEN verified_date END"
    return f"""
SELECT id, result_new, vt AS verification_type_new, {date} AS verified_date_new FROM (
  SELECT *,
    CASE WHEN verification_type IN ('Initial', 'Ews') AND result = 'Pass' THEN 'ACTIVE'
      WHEN verification_type = 'MicroDeposit' AND {deposit_ok} THEN 'ACTIVE'
      WHEN verification_type = 'Yodlee' AND result = 'Pass' THEN 'ACTIVE'
      WHEN verification_type IN ('MicroDeposit', 'Yodlee') THEN 'PENDING_ACH_VALIDATION'
    END AS result_new,
    CASE WHEN verification_type IN ('Initial', 'Ews') AND result = 'Pass' THEN 'EWS'
      WHEN verification_type = 'MicroDeposit' THEN 'MICRODEPOSIT'
      WHEN verification_type = 'Yodlee' THEN 'YODLEE' END AS vt
  FROM ({VER}) v
) c
"""


PIVOT = f"""
SELECT bank_account_verification_id,
  max(amount) FILTER (rn = 1) AS mdamount1, max(amount) FILTER (rn = 2) AS mdamount2,
  max(amount) FILTER (rn = 3) AS mdamount3,
  max(status) FILTER (rn = 1) AS md1_status, max(status) FILTER (rn = 2) AS md2_status,
  max(status) FILTER (rn = 3) AS md3_status,
  max(created_date) FILTER (rn = 1) AS md1_created_timestamp,
  max(created_date) FILTER (rn = 2) AS md2_created_timestamp,
  max(created_date) FILTER (rn = 3) AS md3_created_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY bank_account_verification_id
        ORDER BY created_date, id) AS rn FROM ({TXN}) t) n
GROUP BY bank_account_verification_id
"""

STRICT = """
SELECT o_orderkey, count(l_orderkey) AS n_found,
  CASE WHEN count(l_orderkey) = 1 THEN min(l_partkey) END AS l_partkey,
  CASE WHEN count(l_orderkey) = 1 THEN min(l_suppkey) END AS l_suppkey
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
"""

PRIOR = f"""
SELECT event_id, count(*) OVER (PARTITION BY user_id, week ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS prior
FROM ({ATTEMPT}) a
"""

RETYPED = f"""
SELECT customer_id, CASE WHEN type_id = 1 AND customer_id IN
    (SELECT user_id FROM events WHERE event_type = 'purchase') THEN 2 ELSE type_id END AS type_id,
  type_id AS old_type
FROM ({ACCOUNT}) a
"""

_OK = ["WORK CASE CREATED, STATUS OPEN", "Verification on account ending in: ",
       "Verification Method: Ews", "Verification Status: Successful", "STATUS CHANGED TO RCLOSED"]

OPERATOR_SQL = {
    "pair_images": f"SELECT event_id, user_id, op, prev_id, prev_type, prev_value FROM ({FEED}) f",
    "touching": f"""SELECT event_id, op FROM ({FEED}) f
      WHERE op <> 'U' OR kind IS DISTINCT FROM prev_kind""",
    "touching_changed": f"""SELECT event_id, prev_kind AS old_kind, kind AS new_kind
      FROM ({FEED}) f WHERE op = 'U' AND kind <> prev_kind""",
    "transition": f"""SELECT event_id, user_id FROM ({FEED}) f
      WHERE op = 'U' AND prev_type = 'view' AND event_type = 'purchase'""",
    "route_branches": f"""WITH v AS ({VER})
      SELECT 'legacy' AS branch, count(*) AS n FROM v WHERE is_migrated <> 2
      UNION ALL SELECT 'else_side', count(*) FROM v WHERE is_migrated = 2 OR is_migrated IS NULL
      UNION ALL SELECT 'migrated', count(*) FROM v WHERE is_migrated = 2
      UNION ALL SELECT 'passed', count(*) FROM v WHERE result = 'Pass'
      UNION ALL SELECT 'legacy_passed', count(*) FROM v WHERE is_migrated <> 2 AND result = 'Pass'
      UNION ALL SELECT 'deposit', count(*) FROM v WHERE verification_type = 'MicroDeposit'""",
    "classify_strict": _classify("result = 'Pass'", False),
    "classify_lenient": _classify(_LENIENT, False),
    "classify_lenient_date": _classify(_LENIENT, True),
    "recode_types": f"""SELECT c_custkey,
        CASE WHEN short_code = 'CHK' THEN 'Checking' ELSE 'Savings' END AS short_to_long,
        CASE WHEN long_code = 'Checking' THEN 'CHK' ELSE 'SAV' END AS long_to_short,
        CASE WHEN id_code = 1 THEN 'CHK' ELSE 'SAV' END AS id_to_short,
        CASE short_code WHEN 'SAV' THEN 2 WHEN 'CHK' THEN 1 END AS short_to_id,
        CASE short_code WHEN 'SAV' THEN 'Savings' WHEN 'CHK' THEN 'Checking' END AS short_to_long_strict,
        CASE WHEN short_code = 'CHK' THEN 1 ELSE 2 END AS short_to_id_else,
        CASE channel WHEN 'AGENT' THEN 'CASH' WHEN 'CAS' THEN 'CAS' WHEN 'MOBILE' THEN 'Mobile_App'
          WHEN 'WEB' THEN 'Web' END AS account_channel,
        CASE channel WHEN 'WEB' THEN 'Web' ELSE channel END AS deposit_channel,
        CASE WHEN vtype IS NULL AND res = 'NEW' THEN 'Initial'
          WHEN vtype IS NULL AND res = 'PENDING_ACH_VERIFICATION' THEN 'Ews'
          WHEN vtype = 'AGENT' AND res = 'ACTIVE' THEN 'Ews' WHEN vtype = 'EWS' THEN 'Ews'
          WHEN vtype = 'YODLEE' THEN 'Yodlee' ELSE 'UnKnown' END AS ver_type,
        CASE WHEN vtype IS NULL AND res IN ('NEW', 'PENDING_ACH_VERIFICATION') THEN 'StepUp'
          ELSE 'Pass' END AS ver_result,
        CASE WHEN vtype = 'AGENT' AND res = 'ACTIVE' THEN 'created' ELSE 'verified' END AS ver_date,
        coalesce(res, 'X') AS res_or_x
      FROM ({in_sql(CODED)}) c""",
    "mask_and_text": """SELECT c_custkey, right(c_name, 4) AS last4,
        right(substr(c_name, 1, CAST(c_custkey % 7 AS INTEGER)), 4) AS short4,
        'Bank Information Updated, ' || coalesce(nullif(c_mktsegment, 'BUILDING'), '') || ', '
          || c_nationkey AS line,
        nullif(c_mktsegment, 'BUILDING') AS folded
      FROM customer""",
    "stamp_offset": """SELECT event_id, z AS updated_timestamp,
        z + INTERVAL 11 MICROSECONDS AS change_timestamp,
        ts + INTERVAL 11 MICROSECONDS AS shifted, CAST(ts AS DATE) AS day
      FROM (SELECT *, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles' AS z FROM events) e""",
    "inner_bank": """SELECT o_custkey AS customer_id, o_orderkey, c_name, c_mktsegment
      FROM orders JOIN customer ON c_custkey = o_custkey""",
    "enrich": """SELECT c_custkey, c_name, n_events, last_ts FROM customer LEFT JOIN
      (SELECT user_id, count(*) AS n_events, max(ts) AS last_ts FROM events GROUP BY user_id) e
      ON user_id = c_custkey""",
    "first_match": """SELECT n_nationkey, n_name, s_suppkey, s_name FROM nation LEFT JOIN (
        SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn
        FROM supplier) s ON s_nationkey = n_nationkey AND rn = 1""",
    "latest_verification": f"""SELECT c_custkey AS account, id, created_date, verification_type,
        result FROM customer LEFT JOIN (
          SELECT *, row_number() OVER (PARTITION BY account ORDER BY created_date DESC, id DESC) AS rn
          FROM ({VER}) v
          WHERE result = 'Pass' OR (verification_type = 'MicroDeposit' AND result IS NULL)
        ) l ON account = c_custkey AND rn = 1""",
    "same_day": """SELECT o_orderkey, max(o_orderkey) OVER
        (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)) AS newest_that_day FROM orders""",
    "semi_accounts": """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
        SELECT c_custkey FROM customer WHERE c_nationkey IN (
          SELECT n_nationkey FROM nation WHERE n_regionkey IN (
            SELECT r_regionkey FROM region WHERE r_name = 'ASIA')))""",
    "lookup_one": f"""SELECT *, CASE WHEN n_found = 0 THEN 'missing' WHEN n_found = 1 THEN 'one'
        ELSE 'several' END AS outcome FROM ({STRICT}) s""",
    "reject_log": f"""SELECT CAST(o_orderkey AS VARCHAR) AS event_id, 'reject' AS kind,
        'ODS_STG.STAGE_MODERN_MICRO_DEPOSIT' AS table_name,
        'STAGE_SEQUENCE_ID:' || o_orderkey AS table_id, 'MODERN' AS source_system,
        'LEGACY' AS destination_system, 'FAILED' AS status,
        CASE WHEN n_found = 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END AS failure_reason,
        1 AS failure_count, 'TRIGGER' AS created_by, TIMESTAMP '{NOW}' AS created_timestamp,
        'EXTERNAL_ACCOUNTS' AS domain
      FROM ({STRICT}) s WHERE n_found <> 1""",
    "typed_changes": f"""WITH r AS ({RAW_DEPOSIT}), t AS (SELECT event_id, TRY_CAST(seq AS BIGINT) AS seq,
        TRY_CAST(md_id AS BIGINT) AS md_id, CAST(TRY_CAST(mdamount1 AS DECIMAL(18,2)) AS DOUBLE) AS mdamount1,
        TRY_CAST(verification_attempts AS INTEGER) AS verification_attempts,
        TRY_CAST(created_timestamp AS TIMESTAMP) AS created_timestamp FROM r)
      SELECT *, CASE WHEN mdamount1 IS NULL OR verification_attempts IS NULL OR created_timestamp IS NULL THEN
        'BAD_VALUE: ' || concat_ws(', ', CASE WHEN mdamount1 IS NULL THEN 'after.mdamount1' END,
          CASE WHEN verification_attempts IS NULL THEN 'after.verification_attempts' END,
          CASE WHEN created_timestamp IS NULL THEN 'after.created_timestamp' END) END AS error FROM t""",
    "exists_flag": """SELECT c_custkey, c_custkey IN (SELECT user_id FROM events) AS exists
      FROM customer""",
    "find_or_create": """SELECT event_id, user_id, CASE WHEN user_id IN
          (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000) THEN user_id
        ELSE -1 - min(event_id) OVER (PARTITION BY user_id) END AS id FROM events""",
    "find_or_create_new": """SELECT user_id, -1 - min(event_id) AS id FROM events
      WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000)
      GROUP BY user_id""",
    "update_from": f"""SELECT t.customer_id, coalesce(s.order_id, t.order_id) AS order_id, t.n,
        coalesce(s.last_date, t.last_date) AS last_date
      FROM ({TGT}) t LEFT JOIN ({SRC}) s ON s.customer_id = t.customer_id""",
    "as_of": """WITH h AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS order_id
        FROM orders GROUP BY o_custkey, o_orderdate),
      e AS (SELECT event_id, user_id, ts - INTERVAL 25 YEAR AS moment FROM events)
      SELECT event_id, user_id, order_id FROM e ASOF LEFT JOIN h
        ON user_id = o_custkey AND moment >= o_orderdate""",
    "compare_and_set": """WITH c AS (SELECT event_id, user_id, (SELECT max(p.event_id) FROM events p
          WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.event_id < e.event_id) AS base
        FROM events e WHERE event_type = 'click')
      SELECT c.event_id, c.user_id FROM c LEFT JOIN events p ON p.event_id = c.base
      WHERE (p.event_id IS NULL OR p.value IS NULL OR p.value < 50) AND NOT EXISTS (
        SELECT 1 FROM events g WHERE g.user_id = c.user_id AND g.event_type = 'click' AND g.value >= 20
          AND g.event_id < c.event_id AND g.event_id > coalesce(c.base, -1))""",
    "attempts": f"""SELECT k.user_id, k.week, attempts,
        CASE WHEN attempts = 3 THEN 'Y' ELSE 'N' END AS lock_by_count,
        CASE WHEN attempts IS NOT NULL THEN 'Y' ELSE 'N' END AS lock_by_row
      FROM (SELECT DISTINCT user_id, date_trunc('week', ts) AS week FROM events) k
      LEFT JOIN (SELECT user_id, week, count(*) AS attempts FROM ({ATTEMPT}) a
        GROUP BY user_id, week) c ON c.user_id = k.user_id AND c.week = k.week""",
    "prior_attempts": f"""SELECT event_id, prior, prior + 1 AS attempts,
        CASE WHEN prior = 2 THEN 'Y' ELSE 'N' END AS locked FROM ({PRIOR}) p""",
    "pivot3": PIVOT,
    "debit_override": f"""WITH p AS ({PIVOT}), d AS (
        SELECT bank_account_verification_id, next_status, row_number() OVER
          (PARTITION BY bank_account_verification_id ORDER BY created_date DESC, id DESC) AS rn
        FROM ({TXN}) t WHERE accounting_transaction_type = 'Debit')
      SELECT p.bank_account_verification_id, coalesce(next_status, md1_status) AS md1_status,
        coalesce(next_status, md2_status) AS md2_status,
        coalesce(next_status, md3_status) AS md3_status
      FROM p LEFT JOIN d ON d.bank_account_verification_id = p.bank_account_verification_id
        AND rn = 1""",
    "merge_upsert": f"""SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
        coalesce(s.order_id, t.order_id) AS order_id, t.n,
        CASE WHEN t.customer_id IS NULL THEN s.last_date ELSE t.last_date END AS last_date
      FROM ({TGT}) t FULL JOIN ({SRC}) s ON s.customer_id = t.customer_id""",
    "fold_patches": """WITH t AS (SELECT c_custkey AS user_id, c_acctbal AS value,
          c_mktsegment AS note FROM customer WHERE c_acctbal >= 3000),
      fi AS (SELECT user_id, min(event_id) AS f FROM events WHERE event_type = 'purchase'
        GROUP BY user_id),
      e AS (SELECT events.*, t.user_id IS NOT NULL AS present FROM events
        LEFT JOIN t ON t.user_id = events.user_id LEFT JOIN fi ON fi.user_id = events.user_id
        WHERE t.user_id IS NOT NULL OR event_id >= f),
      p AS (SELECT user_id, bool_or(present) AS present,
          max(event_id) FILTER (event_type IN ('click', 'error', 'purchase')) AS vs,
          max(event_id) FILTER (event_type IN ('signup', 'purchase')) AS ns
        FROM e GROUP BY user_id)
      SELECT coalesce(t.user_id, p.user_id) AS user_id,
        CASE WHEN vs IS NULL THEN t.value WHEN v.event_type = 'error' THEN NULL ELSE v.value END AS value,
        CASE WHEN ns IS NULL THEN t.note ELSE n.props END AS note
      FROM t FULL JOIN p ON p.user_id = t.user_id
      LEFT JOIN events v ON v.event_id = vs LEFT JOIN events n ON n.event_id = ns""",
    "merge_delete": f"""SELECT coalesce(t.customer_id, s.customer_id) AS customer_id,
        CASE WHEN t.customer_id IS NULL THEN s.order_id ELSE t.order_id END AS order_id, t.n,
        coalesce(s.last_date, t.last_date) AS last_date,
        CASE WHEN s.customer_id IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS result
      FROM ({TGT}) t FULL JOIN ({SRC}) s ON s.customer_id = t.customer_id""",
    "merge_delete_matched": f"""SELECT t.customer_id, t.order_id, t.n,
        coalesce(s.last_date, t.last_date) AS last_date,
        CASE WHEN s.customer_id IS NULL THEN 'ACTIVE' ELSE 'INACTIVE' END AS result
      FROM ({TGT}) t LEFT JOIN ({SRC}) s ON s.customer_id = t.customer_id""",
    "verify_guarded": f"""WITH v AS ({VER}), l AS (SELECT id, row_number() OVER
          (PARTITION BY account ORDER BY created_date DESC, id DESC) AS rn
        FROM v WHERE verification_type = 'MicroDeposit')
      SELECT v.id,
        CASE WHEN l.id IS NOT NULL AND verified_date IS NULL THEN 'Pass' ELSE result END AS result,
        CASE WHEN l.id IS NOT NULL AND verified_date IS NULL THEN created_date + INTERVAL 1 DAY
          ELSE verified_date END AS verified_date
      FROM v LEFT JOIN l ON l.id = v.id AND rn = 1""",
    "id_map": """SELECT o_orderkey AS modern_bank_account_id, o_custkey AS legacy_bank_account_id,
        p AS modern_micro_deposit_id, s AS legacy_micro_deposit_id
      FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS p, max(l_suppkey) AS s
        FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""",
    "retype_account": f"SELECT customer_id, type_id FROM ({RETYPED}) r",
    "outbox": f"""SELECT 'type:' || customer_id AS event_id,
        customer_id AS customer_bank_account_id, customer_id, 0 AS change_type
      FROM ({RETYPED}) r WHERE type_id <> old_type""",
    "account_lifecycle": """WITH s AS (SELECT c_custkey AS user_id FROM customer
        WHERE c_acctbal >= 3000),
      a AS (SELECT user_id, 'stored' AS how FROM s UNION ALL
        SELECT DISTINCT user_id, 'opened' FROM events WHERE event_type = 'signup'
          AND user_id NOT IN (SELECT user_id FROM s)),
      l AS (SELECT user_id, arg_max(event_type, ts) AS last_type FROM events GROUP BY user_id)
      SELECT user_id, how FROM a WHERE user_id NOT IN
        (SELECT user_id FROM l WHERE last_type = 'error')""",
    "one_primary": """WITH p AS (SELECT o_custkey, o_orderkey, o_orderkey + 500 AS seq FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F'),
      l AS (SELECT o_custkey, max(seq) AS seq, arg_max(o_orderkey, seq) AS winner
        FROM p GROUP BY o_custkey)
      SELECT o.o_custkey AS customer_id, o_orderkey AS account_id, o_orderkey AS born_seq,
        CASE WHEN o_orderkey < seq THEN CASE WHEN o_orderkey = winner THEN 1 ELSE 0 END
          WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_primary
      FROM orders o LEFT JOIN l ON l.o_custkey = o.o_custkey""",
    "expand_md": f"""SELECT bank_account_verification_id, line_no,
        CASE line_no WHEN 3 THEN 'Debit' ELSE 'Credit' END AS accounting_transaction_type,
        CASE line_no WHEN 1 THEN mdamount1 WHEN 2 THEN mdamount2
          ELSE mdamount1 + mdamount2 END AS amount, 'Received' AS status
      FROM ({PIVOT}) p, (VALUES (1), (2), (3)) n(line_no)""",
    "cases_audit": f"""SELECT id || ':audit' AS uc_audit_id, 1 AS agent_id,
        CASE line_no WHEN 1 THEN '{_OK[0]}' WHEN 2 THEN '{_OK[1]}' || right(CAST(id AS VARCHAR), 4)
          WHEN 3 THEN '{_OK[2]}' WHEN 4 THEN CASE WHEN result = 'Pass' THEN '{_OK[3]}'
            ELSE 'Verification Status:  Failed' END ELSE '{_OK[4]}' END AS data,
        created_date AS audit_date, id || ':case' AS uc_id, line_no, 'order:' || id AS ref_num,
        CASE WHEN result = 'Pass' THEN 415471 ELSE 415472 END AS type_id, 1 AS status_id
      FROM ({VER}) v, (VALUES (1), (2), (3), (4), (5)) n(line_no)""",
    "dense_ids": """SELECT o_orderkey,
        100 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS dense FROM orders""",
    "verification_rows": f"""SELECT id, 2 AS row_no, verification_type,
        created_date + INTERVAL 11 MICROSECONDS AS created_date, result FROM ({VER}) v
      UNION ALL SELECT id, 1, 'Initial', created_date, 'StepUp' FROM ({VER}) v
        WHERE result = 'StepUp'""",
    "history_rows": f"""SELECT CAST(customer_id AS VARCHAR) AS event_id, customer_id,
        3 AS change_code, account_number, routing_number, type_id AS account_type_id,
        segment AS channel FROM ({ACCOUNT}) a""",
    "drop_echo": f"""SELECT event_id FROM ({in_sql(ORIGIN)}) e
      WHERE origin IS NULL OR origin <> 'MODERN'""",
    "drop_sentinel": f"""SELECT event_id FROM ({in_sql(ORIGIN)}) e
      WHERE (origin IS NULL OR origin <> 'MODERN') AND channel <> 'CASH'""",
    "trace_log": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, 'trace' AS kind,
        'T_BAV_MD_VERIFICATION_ATTEMPT' AS table_name,
        'VERIFICATION_LOCKING_ID: ' || user_id AS table_id, 'LEGACY' AS source_system,
        'MODERN' AS destination_system, 'FAILED' AS status,
        'kind_new: ' || coalesce(kind, '') || ' | kind_old: ' || coalesce(prev_kind, '') AS failure_reason,
        1 AS failure_count, 'TRIGGER' AS created_by, TIMESTAMP '{NOW}' AS created_timestamp,
        'EXTERNAL_ACCOUNTS' AS domain
      FROM ({FEED}) f WHERE op = 'U'""",
}
