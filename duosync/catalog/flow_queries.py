"""The complete flows over stand-in tables and feeds."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duosync.catalog import standins as S
from duosync.catalog.operator_queries import now
from duosync.catalog.standins import Data, plain
from duosync.functions.columns import classify
from duosync.operators.deposits import attempts, lock_flag, pivot3
from duosync.operators.lookup import enrich, latest
from duosync.operators.merge import apply_patches
from duosync.plans import legacy_side as legacy
from duosync.plans import modern_side as modern
from duosync.plans.batch import run_batch, with_empty_tables
from duosync.plans.lineage import Scratch, checkpoint_folder
from duosync.plans.target import KEYS, SHAPE, VALUES
from duosync.sources.feeds import as_events
from duosync.sources.schemas import FEEDS, TABLES, schema
from duosync.streaming.stream import TableStore, run_stream

# ------------------------------------------------------------- stand-in tables of the legacy side

VERIFICATION = """
SELECT id AS bank_account_verification_id, verification_type, created_date, verified_date,
  concat('A', id % 10) AS agent, 'Web' AS channel, result,
  account + 1000000 AS credit_account_id, is_migrated, account AS bank_account_id,
  account AS user_id
FROM (""" + S.VER + """) v
"""
# The newest order day of each customer dates the customer account.
DATED = "SELECT a.*, day FROM (" + S.ACCOUNT + """) a
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS day FROM {orders} GROUP BY o_custkey) o
  ON o_custkey = customer_id
"""
# Furniture customers have no account yet; overdrawn ones have two.
CUSTOMER_ACCOUNT = "SELECT customer_id AS customer_bank_account_id, customer_id, routing_number,\
 account_number, type_id AS account_type_id, is_primary, day AS created_date FROM (" + DATED + """) d
WHERE segment <> 'FURNITURE'
UNION ALL
SELECT customer_id + 50000000, customer_id, routing_number, account_number, type_id, 0, day
FROM (""" + DATED + """) d WHERE balance < 0
"""
LOCK = """
SELECT o_orderkey AS id, o_orderdate AS open_date, o_orderkey AS bank_account_verification_id
FROM {orders} WHERE o_orderstatus <> 'F'
"""
COMMITTED = """
SELECT event_id AS id, user_id AS verification_locking_id, ts AS created_date, 'A1' AS agent,
  'Web' AS channel
FROM {events} WHERE event_type = 'click'
"""
STAGED_ACCOUNT = """
SELECT customer_id AS stage_sequence_id, customer_id AS modern_bank_account_id,
  customer_id AS legacy_customer_id, credit_account_id, routing_number, account_number,
  short_type AS account_type, 'ACTIVE' AS result
FROM (""" + S.ACCOUNT + """) a WHERE segment = 'HOUSEHOLD'
"""
TARGET = """
SELECT customer_id AS legacy_customer_id, routing_number, account_number,
  short_type AS account_type, 'ACTIVE' AS result, 'N' AS locked, 0 AS verification_attempts,
  is_primary
FROM (""" + S.TARGET_ACCOUNT + """) t
"""


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a schema; absent ones are NULL."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(ddl).fields
        ]
    )


def legacy_tables(d: Data) -> dict[str, DataFrame]:
    accounts = d.sql(S.ACCOUNT)
    parts = {
        "verification": d.sql(VERIFICATION),
        "transaction": d.transactions(),
        "bank_account": accounts.select(
            F.col("bank_account_id").alias("id"),
            F.col("routing_number").alias("aba_number"),
            "account_number",
            F.col("bank_type").alias("account_type"),
        ),
        "credit_account": accounts,
        "customer_account": d.sql(CUSTOMER_ACCOUNT),
        "lock": d.sql(LOCK),
        "attempt": d.sql(COMMITTED),
        "modern_account": d.sql(STAGED_ACCOUNT),
        "target": d.sql(TARGET),
    }
    return with_empty_tables(d.spark, {n: conform(df, TABLES[n]) for n, df in parts.items()})


def image(values: dict[str, Column], ddl: str) -> Column:
    """An image struct of a feed; absent columns are NULL."""
    return F.struct(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema(ddl).fields
        ]
    )


def _event(df, name, seq, op, before, after, origin=None, updated=None, number=None):
    ddl = FEEDS[name]
    return as_events(
        df,
        event_id=F.concat(F.lit(f"{name}:"), seq.cast("string") if number is None else number),
        seq=seq,
        op=op,
        origin=F.lit(None) if origin is None else origin,
        before=F.when(op != "I", image(before, ddl)),
        after=F.when(op != "D", image(after, ddl)),
        updated_cols=updated,
    )


def _cols(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def customer_account_feed(d: Data) -> DataFrame:
    """One event per customer: the segment says what happened."""
    df = d.sql(DATED)
    op = (
        F.when(F.col("segment") == "AUTOMOBILE", "I")
        .when(F.col("segment") == "BUILDING", "D")
        .otherwise("U")
    )
    new = {
        **_cols("customer_id", "routing_number", "account_number", "is_primary"),
        "customer_bank_account_id": F.col("customer_id"),
        "account_type_id": F.col("type_id"),
        "created_date": F.col("day"),
    }
    old = {
        **new,
        # Machinery changes its type, furniture its flag; household had no flag before.
        "account_type_id": F.when(F.col("segment") == "MACHINERY", 3 - F.col("type_id")).otherwise(
            F.col("type_id")
        ),
        "is_primary": F.when(F.col("segment") == "FURNITURE", 1 - F.col("is_primary")).when(
            F.col("segment") != "HOUSEHOLD", F.col("is_primary")
        ),
    }
    origin = F.when(F.col("nation") < 5, "MODERN")
    return _event(df, "customer_account", F.col("customer_id") * 4, op, old, new, origin)


def verification_feed(d: Data) -> DataFrame:
    df = d.sql(VERIFICATION)
    key = F.col("bank_account_verification_id")
    new = _cols(*df.columns)
    old = {**new, "verified_date": F.lit(None), "result": F.concat(F.lit("OLD"), key % 3)}
    origin = F.when(key % 5 == 0, "MODERN").when(key % 5 == 1, "LEGACY")
    touched = F.array(F.lit("verified_date"))
    return _event(df, "verification", key * 4 + 1, F.lit("U"), old, new, origin, touched)


def attempt_feed(d: Data) -> DataFrame:
    df = d.events.filter(F.col("event_type") == "error")
    new = {
        "id": F.col("event_id"),
        "verification_locking_id": F.col("user_id"),
        "created_date": F.col("ts"),
        "agent": F.lit("A1"),
        "channel": F.when(F.col("value") > 60, "CASH").when(F.col("value") > 5, "Web"),
    }
    origin = F.when(F.col("event_id") % 7 == 0, "MODERN")
    return _event(df, "attempt", F.col("event_id") * 4 + 2, F.lit("I"), {}, new, origin)


def transaction_feed(d: Data) -> DataFrame:
    df = d.transactions()
    new = {**_cols("id", "created_date", "amount", "accounting_transaction_type",
                   "bank_account_verification_id"), "status": F.col("next_status")}
    old = {**new, "status": F.col("status")}
    touched = F.array(F.lit("status"))
    return _event(
        df, "transaction", F.col("seq"), F.lit("U"), old, new, updated=touched, number=F.col("number")
    )


def _target_rows(target: DataFrame) -> DataFrame:
    return plain(target.select(*KEYS, *VALUES))


def _merged(d: Data, patches: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    return _target_rows(apply_patches(tables["target"], patches, SHAPE))


def account_status(d: Data) -> DataFrame:
    """Current status of each account: its newest verification, classified, with its first
    three deposits, its attempts and its lock."""
    accounts = d.customer.select(F.col("c_custkey").alias("account"), "c_name")
    out = latest(accounts, d.sql(S.VER), ["account"], [F.col("created_date"), F.col("id")])
    out = classify(out, "lenient", "classified").withColumnRenamed(
        "id", "bank_account_verification_id"
    )
    piv = pivot3(d.sql(S.TXN), "bank_account_verification_id", ["created_date", "id"])
    out = out.join(piv, ["bank_account_verification_id"], "left")
    tried = d.events.filter(F.col("event_type") == "error").select(
        F.col("user_id").alias("account")
    )
    out = out.join(attempts(tried, ["account"]), ["account"], "left")
    return plain(
        out.select(
            "account", "c_name", "bank_account_verification_id", "result_new",
            "verification_type_new", "verified_date_new", "mdamount1", "mdamount2", "mdamount3",
            "md1_status", "md2_status", "md3_status", "attempts",
            lock_flag("attempts", "count").alias("locked"),
        )
    )


def flow_customer(d: Data) -> DataFrame:
    t = legacy_tables(d)
    cut = Scratch(d.spark)
    res = legacy.apply_customer_accounts(
        customer_account_feed(d), t, now(), mask=False,
        enriched=cut(legacy.enrich_customer_accounts(customer_account_feed(d), t, cut)),
    )
    return _merged(d, res["patches"], t)


def flow_customer_log(d: Data) -> DataFrame:
    t = legacy_tables(d)
    cut = Scratch(d.spark)
    ev = customer_account_feed(d)
    res = legacy.apply_customer_accounts(
        ev, t, now(), mask=False, enriched=legacy.enrich_customer_accounts(ev, t, cut)
    )
    return _log(res["log"])


def _log(log: DataFrame) -> DataFrame:
    return log.select("event_id", "kind", "table_id", "status", "failure_reason", "failure_count")


def flow_verification(d: Data) -> DataFrame:
    t = legacy_tables(d)
    cut = Scratch(d.spark)
    ev = verification_feed(d)
    res = legacy.apply_verifications(
        ev, t, now(), enriched=cut(legacy.enrich_verifications(ev, t, cut))
    )
    return _merged(d, res["patches"], t)


def flow_verification_log(d: Data) -> DataFrame:
    t = legacy_tables(d)
    cut = Scratch(d.spark)
    ev = verification_feed(d)
    enriched = cut(legacy.enrich_verifications(ev, t, cut))
    return _log(legacy.apply_verifications(ev, t, now(), mask=False, enriched=enriched)["log"])


def flow_attempt(d: Data) -> DataFrame:
    t = legacy_tables(d)
    cut = Scratch(d.spark)
    ev = attempt_feed(d)
    res = legacy.apply_attempts(
        ev, t, now(), enriched=cut(legacy.enrich_attempts(ev, t, t["attempt"], cut))
    )
    return _merged(d, res["patches"], t)


def flow_transaction(d: Data) -> DataFrame:
    t = legacy_tables(d)
    res = legacy.apply_transaction_status(transaction_feed(d), t, now())
    return _merged(d, res["patches"], t)


def legacy_feeds(d: Data) -> dict[str, DataFrame]:
    return {
        "customer_account": customer_account_feed(d),
        "verification": verification_feed(d),
        "attempt": attempt_feed(d),
        "transaction": transaction_feed(d),
    }


def run_batch_query(d: Data) -> DataFrame:
    """All four legacy feeds in one batch; the target afterwards."""
    return _target_rows(run_batch(legacy_feeds(d), legacy_tables(d), now()).tables["target"])


def run_stream_query(d: Data) -> DataFrame:
    """The same feeds as a stream over Parquet folders, into a bucketed target.

    Two runs of the stream share the events by number: the second has those after the last one of the second longest
    feed. Some events of that feed come again in it, which changes nothing.
    """
    root = f"{checkpoint_folder(d.spark)}/stream-{uuid.uuid4().hex}"
    feeds = legacy_feeds(d)
    last = {name: feed.agg(F.max("seq")).first()[0] or 0 for name, feed in feeds.items()}
    *_, middle, _ = sorted(last.values())
    paths = {name: f"{root}/feeds/{name}" for name in feeds}
    first = {name: F.col("seq") <= middle for name in feeds}
    longest = max(last, key=last.get)
    second = {longest: (F.col("seq") > middle) | F.col("event_id").endswith("7")}
    store = TableStore(d.spark, f"{root}/tables", buckets=8)
    store.create(legacy_tables(d))
    for parts in (first, second):
        for name, part in parts.items():
            feeds[name].filter(part).write.mode("append").parquet(paths[name])
        run_stream(
            d.spark, paths, store, f"{root}/out", f"{root}/checkpoint", now=now
        ).awaitTermination()
    return _target_rows(store.load()["target"])


# --------------------------------------------------------------- stand-ins of the modern side

# What the event of an order is: status and priority pick one of the scenarios.
STORED = "(o_orderstatus = 'F' OR (o_orderstatus = 'P' AND priority IN ('2', '3', '5')))"
OTHER_TYPE = "CASE account_type WHEN 'CHK' THEN 'SAV' ELSE 'CHK' END"
RETYPES = "(o_orderstatus = 'F' AND priority IN ('1', '2'))"
MODERN_EVENT = """
SELECT o.*, CASE o_orderstatus WHEN 'O' THEN 'I' ELSE 'U' END AS op,
  CASE WHEN o_orderstatus = 'O' THEN 'ADD'
    WHEN priority = '3' AND o_orderstatus = 'P' THEN 'PRIMARY_UPDATE'
    WHEN priority = '5' AND o_orderstatus = 'P' THEN 'DELETE'
    WHEN priority = '3' THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
  CASE WHEN o_orderstatus = 'O' AND priority = '5' THEN '1' ELSE '0' END AS single_use,
  CASE WHEN o_orderstatus = 'O' THEN CASE priority WHEN '2' THEN 'AGENT' WHEN '3' THEN 'EWS'
    WHEN '5' THEN 'MICRODEPOSIT' END END AS verification_type,
  CASE WHEN o_orderstatus = 'O' THEN CASE priority WHEN '1' THEN 'PENDING_ACH_VERIFICATION'
      WHEN '4' THEN 'NEW' ELSE 'ACTIVE' END
    WHEN o_orderstatus = 'P' AND priority = '1' THEN 'PENDING_ACH_VALIDATION'
    ELSE 'ACTIVE' END AS result,
  CASE WHEN o_orderstatus = 'P' THEN CASE priority WHEN '1' THEN 'PENDING_ACH_VERIFICATION'
    WHEN '2' THEN 'PENDING_ACH_VALIDATION' ELSE 'ACTIVE' END ELSE 'ACTIVE' END AS old_result,
  CASE WHEN priority = '3' OR (o_orderstatus = 'F' AND priority = '2') THEN 1 ELSE 0 END AS new_primary,
  CASE WHEN """ + RETYPES + " THEN " + OTHER_TYPE + """ ELSE account_type END AS old_account_type,
  CASE WHEN o_orderstatus = 'P' AND priority = '4' THEN 'X' ELSE routing_number END AS old_routing,
  """ + STORED + """ AS is_stored
FROM (""" + S.ORDER_ACCOUNT + """) o
"""
# Deposits of orders from the first half of a year have a verification.
STARTED = """
SELECT n AS bank_account_verification_id, 'MicroDeposit' AS verification_type,
  o_orderdate AS created_date, CASE WHEN n % 4 = 0 THEN o_orderdate END AS verified_date,
  n + 5000000 AS work_case_id, '640' AS agent, 'Web' AS channel,
  credit_account_id, 2 AS is_migrated, n AS bank_account_id, customer_id AS user_id
FROM (""" + S.ORDER_ACCOUNT + """) o
WHERE o_orderstatus <> 'O' AND month(o_orderdate) <= 6
"""


def modern_tables(d: Data) -> dict[str, DataFrame]:
    events = d.sql(MODERN_EVENT)
    accounts = d.sql(S.ACCOUNT)
    known = events.filter(F.col("op") == "U")
    names = accounts.select(F.col("customer_id").alias("name_id"), F.col("account_number").alias("name"))
    parts = {
        "customer_account": events.filter("is_stored").select(
            F.col("n").alias("customer_bank_account_id"), "customer_id", "routing_number",
            "account_number",
            F.when(F.col("old_account_type") == "CHK", 1).otherwise(2).alias("account_type_id"),
            F.lit(0).alias("is_primary"), F.col("o_orderdate").alias("created_date"),
        ),
        "bank_account": known.select(
            F.col("n").alias("id"), F.col("routing_number").alias("aba_number"),
            "account_number", F.col("bank_type").alias("account_type"),
        ),
        "user": accounts.filter("balance >= 3000").select(
            F.col("customer_id").alias("id"),
            F.col("customer_id").alias("individual_identifier"),
            F.lit(2).alias("identifier_type"),
            F.col("account_number").alias("individual_name"),
        ),
        "card": accounts.select(
            F.col("customer_id").alias("card_id"), "credit_account_id",
            F.lit(1).alias("current_card"),
        ),
        "holder": accounts.select(
            "customer_id", "credit_account_id", F.col("customer_id").alias("name_id")
        ),
        "name": names,
        "bank_directory": d.nation.select(
            F.concat(F.lit("R"), "n_nationkey").alias("rt_micr"), F.col("n_name").alias("rt_instit")
        ),
        "verification": d.sql(STARTED),
        "transaction": d.sql(S.TXN),
        "deposit_verification": d.sql(STARTED).select(
            F.lit("640").alias("verification_agent"), F.lit("Web").alias("verification_channel"),
            "bank_account_verification_id",
        ),
        "lock": d.orders.filter(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("open_date"),
            F.col("o_orderkey").alias("bank_account_verification_id"),
        ),
        "modern_account": events.select(
            F.col("n").alias("stage_sequence_id"), F.col("n").alias("modern_bank_account_id"),
            "credit_account_id",
        ),
    }
    return with_empty_tables(d.spark, {n: conform(df, TABLES[n]) for n, df in parts.items()})


def modern_account_feed(d: Data) -> DataFrame:
    df = d.sql(MODERN_EVENT)
    new = {
        **_cols("routing_number", "account_number", "account_type", "credit_account_id",
                "operation_type", "single_use", "verification_type", "result"),
        "stage_sequence_id": F.col("n"),
        "modern_bank_account_id": F.col("n"),
        "legacy_customer_id": F.col("customer_id"),
        "is_primary": F.col("new_primary"),
        "channel": F.when(F.col("n") % 3 == 0, "WEB").otherwise("AGENT"),
        "created_by": F.lit("C1"),
        "updated_by": F.lit("U1"),
        "created_timestamp": F.col("o_orderdate"),
        "updated_timestamp": F.expr("o_orderdate + INTERVAL 1 DAY"),
    }
    old = {
        **new,
        "result": F.col("old_result"),
        "is_primary": F.lit(0),
        "account_type": F.col("old_account_type"),
        "routing_number": F.col("old_routing"),
    }
    return _event(df, "modern_account", F.col("n"), F.col("op"), old, new)


def modern_deposit_feed(d: Data) -> DataFrame:
    df = d.sql(S.ORDER_ACCOUNT)
    pr = F.col("priority")
    is_new = F.col("o_orderstatus") == "O"
    new = {
        **_cols("routing_number", "account_number", "account_type"),
        "stage_sequence_id": F.col("n"),
        "md_id": F.col("n") + 7000000,
        "modern_bank_account_id": F.col("n"),
        "legacy_customer_id": F.col("customer_id"),
        "md_status": F.when(is_new & (pr > "3"), "Processed")
        .when(is_new, "InProgress")
        .when(pr == "1", "Processed")
        .when(pr == "2", "Cancel")
        .otherwise("InProgress"),
        "mdamount1": F.lit(0.11) + F.col("n") % 7,
        "mdamount2": F.when(F.col("n") % 9 != 0, F.lit(0.25)),
        "verification_attempts": F.when(pr == "3", 1).when(pr > "3", 2).otherwise(0),
        "locked": F.when(pr == "4", "1").otherwise("0"),
        "channel": F.when(F.col("n") % 3 == 0, "WEB").otherwise("AGENT"),
        "created_timestamp": F.col("o_orderdate"),
        "updated_timestamp": F.expr("o_orderdate + INTERVAL 2 DAYS"),
    }
    old = {
        **new,
        "md_status": F.lit("InProgress"),
        "verification_attempts": F.when(pr == "3", 0).when(pr == "4", 1).when(pr < "3", 0),
        "locked": F.lit("0"),
    }
    op = F.when(is_new, "I").otherwise("U")
    touched = F.array(F.lit("md_status"), F.lit("verification_attempts"), F.lit("locked"))
    return _event(df, "modern_deposit", F.col("n"), op, old, new, updated=touched)


def _accounts(d: Data) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    t, cut = modern_tables(d), Scratch(d.spark)
    parties = modern.resolve_parties(modern_account_feed(d), t, cut)
    steps = Scratch(d.spark)
    decided = cut(modern.decide_accounts(parties[0], t, cut=steps))
    steps.release()
    res = modern.apply_modern_accounts(
        parties[0], t, now(), parties=parties, mask=False, decided=decided
    )
    return res, t


def flow_account(d: Data) -> DataFrame:
    """Customer accounts after one modern event per order."""
    res, t = _accounts(d)
    out = modern.account_snapshot(t["customer_account"], res)
    return out.select(
        "customer_bank_account_id", "customer_id", "account_number", "account_type_id", "is_primary"
    )


def flow_account_audit(d: Data) -> DataFrame:
    return _accounts(d)[0]["audit"].select("uc_id", "line_no", "data")


def flow_account_verification(d: Data) -> DataFrame:
    return plain(_accounts(d)[0]["verification"])


def flow_account_outbox(d: Data) -> DataFrame:
    return _accounts(d)[0]["outbox"]


def flow_account_log(d: Data) -> DataFrame:
    return _log(_accounts(d)[0]["log"])


def flow_account_users(d: Data) -> DataFrame:
    return _accounts(d)[0]["user"].select("id", "individual_identifier", "individual_name")


CASE_COLUMNS = [
    "uc_id", "status_id", "type_id", "ref_num", "open_date", "open_agent_id", "status_date",
    "status_agent_id", "credit_account_id", "card_id",
]


def flow_account_cases(d: Data) -> DataFrame:
    return plain(_accounts(d)[0]["case"].select(CASE_COLUMNS))


def flow_account_history(d: Data) -> DataFrame:
    return _accounts(d)[0]["history"]


def flow_account_id_map(d: Data) -> DataFrame:
    return _accounts(d)[0]["id_map"].select(
        "modern_bank_account_id", "legacy_bank_account_id", "created_by"
    )


def flow_account_banks(d: Data) -> DataFrame:
    return _accounts(d)[0]["bank_account"].select("id", "aba_number", "account_number", "account_type")


def flow_account_verified(d: Data) -> DataFrame:
    """Stored verifications that an activated account completes."""
    return plain(
        _accounts(d)[0]["verification_patch"].select(
            "bank_account_verification_id", "verified_date", "result"
        )
    )


def _deposits(d: Data) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    t, cut = modern_tables(d), Scratch(d.spark)
    ev = modern_deposit_feed(d)
    enriched = cut(modern.enrich_deposits(ev, t, cut))
    return modern.apply_modern_deposits(ev, t, now(), mask=False, enriched=enriched), t


def flow_deposit(d: Data) -> DataFrame:
    """Transactions after one deposit event per order."""
    res, t = _deposits(d)
    out = modern.deposit_tables(t, res)["transaction"]
    return plain(
        out.select(
            "id", "bank_account_verification_id", "accounting_transaction_type", "amount",
            "status", "post_date",
        )
    )


def flow_deposit_audit(d: Data) -> DataFrame:
    return _deposits(d)[0]["audit"].select("uc_id", "line_no", "data")


def flow_deposit_attempts(d: Data) -> DataFrame:
    return plain(_deposits(d)[0]["attempt"])


def flow_deposit_cases(d: Data) -> DataFrame:
    return plain(_deposits(d)[0]["case"].select(CASE_COLUMNS))


def flow_deposit_verifications(d: Data) -> DataFrame:
    """Verifications of the deposits that start."""
    return plain(
        _deposits(d)[0]["verification"].select(
            "bank_account_verification_id", "verification_type", "created_date", "work_case_id",
            "agent", "channel", "is_migrated", "credit_account_id",
        )
    )


def flow_deposit_checks(d: Data) -> DataFrame:
    """Micro-deposit verifications with their posting and cancellation."""
    res, t = _deposits(d)
    return plain(
        modern.deposit_tables(t, res)["deposit_verification"].select(
            "bank_account_verification_id", "ach_posted_date", "canceled_date",
            "verification_agent", "verification_channel",
        )
    )


def flow_deposit_locks(d: Data) -> DataFrame:
    return plain(_deposits(d)[0]["lock"])


def flow_deposit_id_map(d: Data) -> DataFrame:
    return _deposits(d)[0]["id_map_patch"].select(
        "modern_bank_account_id", "modern_micro_deposit_id", "legacy_micro_deposit_id"
    )


def flow_deposit_log(d: Data) -> DataFrame:
    return _log(_deposits(d)[0]["log"])


FLOWS = {
    "account_status": account_status,
    "flow_customer": flow_customer,
    "flow_customer_log": flow_customer_log,
    "flow_verification": flow_verification,
    "flow_verification_log": flow_verification_log,
    "flow_attempt": flow_attempt,
    "flow_transaction": flow_transaction,
    "flow_account": flow_account,
    "flow_account_audit": flow_account_audit,
    "flow_account_verification": flow_account_verification,
    "flow_account_outbox": flow_account_outbox,
    "flow_account_log": flow_account_log,
    "flow_account_users": flow_account_users,
    "flow_account_cases": flow_account_cases,
    "flow_account_history": flow_account_history,
    "flow_account_id_map": flow_account_id_map,
    "flow_account_banks": flow_account_banks,
    "flow_account_verified": flow_account_verified,
    "flow_deposit": flow_deposit,
    "flow_deposit_cases": flow_deposit_cases,
    "flow_deposit_verifications": flow_deposit_verifications,
    "flow_deposit_checks": flow_deposit_checks,
    "flow_deposit_locks": flow_deposit_locks,
    "flow_deposit_id_map": flow_deposit_id_map,
    "flow_deposit_audit": flow_deposit_audit,
    "flow_deposit_attempts": flow_deposit_attempts,
    "flow_deposit_log": flow_deposit_log,
    "run_batch": run_batch_query,
    "run_stream": run_stream_query,
}
