"""One query per operator, over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duosync.catalog import standins as S
from duosync.catalog.standins import Data, plain
from duosync.functions import codes
from duosync.functions import columns as C
from duosync.operators import deposits, generate, lookup, merge, rejects, route
from duosync.plans.lineage import Scratch
from duosync.sources import feeds
from duosync.sources.feeds import pair_images
from duosync.sources.schemas import schema

NOW = "2026-01-01 12:00:00"


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def feed(d: Data) -> DataFrame:
    """Events as versions of their user, with images; ``kind`` is NULL for sign-ups."""
    rows = d.events.select(
        "user_id",
        "ts",
        "event_id",
        "event_type",
        "value",
        F.nullif(F.col("event_type"), F.lit("signup")).alias("kind"),
    )
    cols = ["event_id", "event_type", "value", "kind"]
    out = pair_images(rows, ["user_id"], "ts", cols)
    return out.withColumn(
        "op",
        F.when(F.col("before").isNull(), "I")
        .when(F.col("event_type") == "error", "D")
        .otherwise("U"),
    )


def pair_images_query(d: Data) -> DataFrame:
    return feed(d).select(
        "event_id",
        "user_id",
        "op",
        F.col("before.event_id").alias("prev_id"),
        F.col("before.event_type").alias("prev_type"),
        F.col("before.value").alias("prev_value"),
    )


def touching_changed(d: Data) -> DataFrame:
    hit = route.changed(route.touching(feed(d), ["kind"]), ["kind"])
    return hit.select(
        "event_id", F.col("before.kind").alias("old_kind"), F.col("after.kind").alias("new_kind")
    )


def touching_query(d: Data) -> DataFrame:
    return route.touching(feed(d), ["kind"]).select("event_id", "op")


def transition(d: Data) -> DataFrame:
    return route.transition(feed(d), "event_type", "view", "purchase").select(
        "event_id", "user_id"
    )


def route_branches(d: Data) -> DataFrame:
    """Branch sizes in one pass; an order may be in several branches."""
    ver = d.sql(S.VER)
    passed = F.col("result") == "Pass"
    legacy = route.not_migrated("is_migrated")
    branches = {
        "legacy": legacy,
        "else_side": ~legacy,
        "migrated": F.col("is_migrated") == codes.MIGRATED,
        "passed": passed,
        "legacy_passed": legacy & passed,
        "deposit": F.col("verification_type") == "MicroDeposit",
    }
    flagged = route.flag_branches(ver, branches)
    counts = flagged.agg(*[F.count(F.when(F.col(b), 1)).alias(b) for b in branches])
    pairs = F.array(*[F.struct(F.lit(b).alias("branch"), F.col(b).alias("n")) for b in branches])
    return counts.select(F.inline(pairs))


def _classify(d: Data, md_rule: str, date_rule: str) -> DataFrame:
    out = C.classify(d.sql(S.VER), md_rule, date_rule)
    return plain(out.select("id", "result_new", "verification_type_new", "verified_date_new"))


def classify_strict(d: Data) -> DataFrame:
    return _classify(d, "strict", "classified")


def classify_lenient(d: Data) -> DataFrame:
    return _classify(d, "lenient", "classified")


def classify_lenient_date(d: Data) -> DataFrame:
    return _classify(d, "lenient", "always")


CODED = """
SELECT c_custkey,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'CHK' WHEN 'MACHINERY' THEN 'SAV'
    WHEN 'HOUSEHOLD' THEN NULL ELSE 'OTHER' END AS short_code,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Checking' WHEN 'MACHINERY' THEN 'Savings' END AS long_code,
  CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3 END AS id_code,
  CASE c_nationkey % 6 WHEN 0 THEN 'AGENT' WHEN 1 THEN 'CAS' WHEN 2 THEN 'MOBILE'
    WHEN 3 THEN 'WEB' WHEN 4 THEN 'OTHER' END AS channel,
  CASE c_custkey % 5 WHEN 0 THEN 'AGENT' WHEN 1 THEN 'EWS' WHEN 2 THEN 'YODLEE'
    WHEN 3 THEN 'MICRODEPOSIT' END AS vtype,
  CASE c_custkey % 4 WHEN 0 THEN 'NEW' WHEN 1 THEN 'PENDING_ACH_VERIFICATION'
    WHEN 2 THEN 'ACTIVE' END AS res
FROM {customer}
"""


def recode_types(d: Data) -> DataFrame:
    df = d.sql(CODED)
    ver = C.recode_verification("vtype", "res", F.lit("created"), F.lit("verified"))
    return df.select(
        "c_custkey",
        C.recode_account_type("short_code", "short", "long", "savings").alias("short_to_long"),
        C.recode_account_type("long_code", "long", "short", "savings").alias("long_to_short"),
        C.recode_account_type("id_code", "id", "short", "savings").alias("id_to_short"),
        C.recode_account_type("short_code", "short", "id", None).alias("short_to_id"),
        C.recode_account_type("short_code", "short", "long", None).alias("short_to_long_strict"),
        C.recode_account_type("short_code", "short", "id", "savings").alias("short_to_id_else"),
        C.recode_channel("channel", "account").alias("account_channel"),
        C.recode_channel("channel", "deposit").alias("deposit_channel"),
        ver["verification_type"].alias("ver_type"),
        ver["result"].alias("ver_result"),
        ver["verified_date"].alias("ver_date"),
        C.default_null("res", "X").alias("res_or_x"),
    )


def mask_and_text(d: Data) -> DataFrame:
    short = F.substring(F.col("c_name"), F.lit(1), (F.col("c_custkey") % 7).cast("int"))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return d.customer.select(
        "c_custkey",
        C.last_four("c_name").alias("last4"),
        C.last_four(short).alias("short4"),
        C.text("Bank Information Updated, ", segment, ", ", F.col("c_nationkey")).alias("line"),
        C.fold_case(F.lower(segment)).alias("folded"),
    )


def stamp_offset(d: Data) -> DataFrame:
    df = C.stamp(d.events, F.col("ts"))
    return plain(
        df.select(
            "event_id",
            "updated_timestamp",
            "change_timestamp",
            C.plus_micros("ts").alias("shifted"),
            lookup.same_day("ts").alias("day"),
        )
    )


def inner_bank(d: Data) -> DataFrame:
    orders = d.orders.select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    names = d.customer.select(F.col("c_custkey").alias("customer_id"), "c_name", "c_mktsegment")
    return lookup.inner(orders, names, ["customer_id"])


def enrich(d: Data) -> DataFrame:
    totals = d.events.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_events"), F.max("ts").alias("last_ts")
    )
    return plain(lookup.enrich(d.customer.select("c_custkey", "c_name"), totals, ["c_custkey"]))


def first_match(d: Data) -> DataFrame:
    dim = d.supplier.select(F.col("s_nationkey").alias("n_nationkey"), "s_suppkey", "s_name")
    return lookup.first_match(
        d.nation.select("n_nationkey", "n_name"), dim, ["n_nationkey"], [F.col("s_suppkey")]
    )


def latest_verification(d: Data) -> DataFrame:
    pred = (F.col("result") == "Pass") | (
        (F.col("verification_type") == "MicroDeposit") & F.col("result").isNull()
    )
    accounts = d.customer.select(F.col("c_custkey").alias("account"))
    out = lookup.latest(
        accounts, d.sql(S.VER), ["account"], [F.col("created_date"), F.col("id")], pred
    )
    return plain(out.select("account", "id", "created_date", "verification_type", "result"))


def same_day(d: Data) -> DataFrame:
    orders = d.orders.select(
        "o_orderkey", "o_custkey", lookup.same_day("o_orderdate").alias("day")
    )
    twins = orders.select("o_custkey", "day", F.col("o_orderkey").alias("newest_that_day"))
    return lookup.latest(
        orders, twins, ["o_custkey", "day"], [F.col("newest_that_day")]
    ).select("o_orderkey", "newest_that_day")


def semi_accounts(d: Data) -> DataFrame:
    region = d.region.filter(F.col("r_name") == "ASIA").select(
        F.col("r_regionkey").alias("n_regionkey")
    )
    nations = lookup.semi(d.nation, region, ["n_regionkey"])
    customers = lookup.semi(
        d.customer.withColumnRenamed("c_nationkey", "n_nationkey"), nations, ["n_nationkey"]
    )
    return lookup.semi(
        d.orders.withColumnRenamed("o_custkey", "c_custkey"), customers, ["c_custkey"]
    ).select("o_orderkey", F.col("c_custkey").alias("o_custkey"))


def _strict(d: Data) -> DataFrame:
    lines = d.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey")
    return lookup.lookup_one(d.orders.select("o_orderkey"), lines, ["o_orderkey"])


def lookup_one(d: Data) -> DataFrame:
    one, missing, several = lookup.split_strict(_strict(d))
    parts = {"one": one, "missing": missing, "several": several}
    return rejects.union_all(
        [p.withColumn("outcome", F.lit(name)) for name, p in parts.items()]
    ).select("o_orderkey", "n_found", "l_partkey", "l_suppkey", "outcome")


def reject_log(d: Data) -> DataFrame:
    df = _strict(d).filter(F.col("n_found") != 1)
    df = df.withColumn("event_id", F.col("o_orderkey").cast("string"))
    reason = F.when(F.col("n_found") == 0, "MISSING").otherwise("AMBIGUOUS")
    log = rejects.rejects(
        df, "modern_deposit", rejects.MODERN_TO_LEGACY,
        rejects.prefixed_id("modern_deposit", F.col("o_orderkey")), reason, now(), 1,
    )
    return plain(log.drop("updated_by", "updated_timestamp", "trigger_input", "trigger_name"))


def typed_changes(d: Data) -> DataFrame:
    """Orders as a feed of texts, some of which are no numbers, no times or too large."""
    row = schema("md_id long, mdamount1 decimal(18,2), verification_attempts int, created_timestamp timestamp")
    raw = d.sql(S.RAW_DEPOSIT)
    after = F.struct(*[F.col(f.name) for f in row.fields])
    envelope = raw.select(
        "event_id", "seq", F.lit("I").alias("op"), F.lit(None).cast("string").alias("origin"),
        F.lit(None).cast("array<string>").alias("updated_cols"),
        F.lit(None).cast(T.StructType([T.StructField(f.name, T.StringType()) for f in row.fields])).alias("before"),
        after.alias("after"),
    )
    return plain(feeds.typed_changes(envelope, row).select("event_id", "seq", "after.*", "error"))


def exists_flag(d: Data) -> DataFrame:
    users = d.events.select(F.col("user_id").alias("c_custkey"))
    return lookup.exists_flag(d.customer.select("c_custkey"), users, ["c_custkey"])


def _find_or_create(d: Data) -> tuple[DataFrame, DataFrame]:
    known = d.customer.filter(F.col("c_acctbal") >= 3000).select(
        F.col("c_custkey").alias("user_id"), F.col("c_custkey").alias("id")
    )
    ev = d.events.select("user_id", "event_id")
    return lookup.find_or_create(
        ev, known, ["user_id"], "event_id",
        lambda m: m.select("user_id", (-F.col("event_id") - 1).alias("id")),
    )


def find_or_create(d: Data) -> DataFrame:
    return _find_or_create(d)[0].select("event_id", "user_id", "id")


def find_or_create_new(d: Data) -> DataFrame:
    return _find_or_create(d)[1].select("user_id", "id")


def update_from(d: Data) -> DataFrame:
    out = lookup.update_from(d.sql(S.TGT), d.sql(S.SRC), ["customer_id"], ["order_id", "last_date"])
    return plain(out)


def as_of(d: Data) -> DataFrame:
    """The customer's newest order 25 years before each event."""
    ev = d.events.select("event_id", "user_id", F.expr("ts - INTERVAL 25 YEARS").alias("at"))
    history = d.orders.groupBy(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at")
    ).agg(F.max("o_orderkey").alias("order_id"))
    out = lookup.enrich_as_of(
        ev, history, ["user_id"], "at", ["order_id"],
        inclusive=True, width=365 * 24 * 3600 * 1_000_000,
    )
    return out.select("event_id", "user_id", "order_id")


def compare_and_set(d: Data) -> DataFrame:
    """Clicks that fill a user's cell: purchases of 50 or more set it, cheaper ones clear it, and a click of 20
    or more sets it only while it is empty."""
    ev = d.events.select("event_id", "user_id", "event_type", "value")
    plain_writes = ev.filter("event_type = 'purchase'").select(
        "user_id", "event_id", F.when(F.col("value") >= 50, F.col("value")).alias("there"),
        F.col("event_id").alias("written"),
    )
    clicks = ev.filter("event_type = 'click'").select("event_id", "user_id", "value")
    seen = lookup.enrich_as_of(clicks, plain_writes, ["user_id"], "event_id", ["there", "written"])
    seen = seen.withColumn("written", F.coalesce("written", F.lit(-1)))
    filled = F.when(F.col("value") >= 20, F.col("value"))
    out = merge.compare_and_set(seen, ["user_id", "written"], "event_id", F.col("there"), filled)
    return out.select("event_id", "user_id")


def attempts(d: Data) -> DataFrame:
    locks = d.events.select("user_id", F.date_trunc("week", "ts").alias("week")).distinct()
    counted = deposits.attempts(d.sql(S.ATTEMPT), ["user_id", "week"])
    out = lookup.enrich(locks, counted, ["user_id", "week"])
    return plain(
        out.withColumns(
            {
                "lock_by_count": deposits.lock_flag("attempts", "count"),
                "lock_by_row": deposits.lock_flag("attempts", "row"),
            }
        )
    )


def prior_attempts(d: Data) -> DataFrame:
    out = deposits.prior_attempts(d.sql(S.ATTEMPT), ["user_id", "week"], "ts")
    return out.select(
        "event_id",
        "prior",
        (F.col("prior") + 1).alias("attempts"),
        deposits.lock_flag("prior", "prior").alias("locked"),
    )


def pivot3(d: Data) -> DataFrame:
    return plain(
        deposits.pivot3(d.sql(S.TXN), "bank_account_verification_id", ["created_date", "id"])
    )


def debit_override(d: Data) -> DataFrame:
    """The newest debit's status becomes all three statuses of its order."""
    txn, key = d.sql(S.TXN), "bank_account_verification_id"
    out = deposits.pivot3(txn, key, ["created_date", "id"])
    debit = txn.filter(F.col("accounting_transaction_type") == "Debit")
    last = lookup.pick_one(debit, [key], [F.col("created_date"), F.col("id")], newest=True)
    patch = last.select(key, *[c.alias(n) for n, c in deposits.override_statuses("next_status").items()])
    names = list(deposits.override_statuses("next_status"))
    return lookup.update_from(out, patch, [key], names).select(key, *names)


def merge_upsert(d: Data) -> DataFrame:
    out = merge.merge_upsert(
        d.sql(S.TGT), d.sql(S.SRC), ["customer_id"], ["order_id"], ["order_id", "last_date"]
    )
    return plain(out)


USER_SHAPE = merge.PatchShape(
    keys=("user_id",),
    columns=("value", "note"),
    sets=(("value",), ("value", "note"), ("note",)),
    types=("double", "string"),
)


def user_patches(d: Data) -> DataFrame:
    """Click sets the value, error sets it to NULL, purchase sets both columns and may insert,
    sign-up sets the note; view changes nothing."""
    ev = d.events.select(
        "user_id",
        F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.col("props").alias("note"),
    )

    def kind(types, update, insert=None):
        return merge.with_masks(ev.filter(F.col("event_type").isin(*types)), USER_SHAPE, update, insert)

    return rejects.union_all(
        [
            kind(["click", "error"], ["value"]),
            kind(["purchase"], ["value", "note"], ["value", "note"]),
            kind(["signup"], ["note"]),
        ]
    )


def fold_patches(d: Data) -> DataFrame:
    tgt = d.customer.filter(F.col("c_acctbal") >= 3000).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_acctbal").alias("value"),
        F.col("c_mktsegment").alias("note"),
    )
    out = merge.apply_patches(tgt, user_patches(d), USER_SHAPE)
    return out.select("user_id", "value", "note")


def merge_delete(d: Data) -> DataFrame:
    tgt = d.sql(S.TGT).withColumn("result", F.lit("ACTIVE"))
    return plain(
        merge.merge_delete(
            tgt, d.sql(S.SRC), ["customer_id"], ["last_date"], ["order_id", "last_date"]
        )
    )


def merge_delete_matched(d: Data) -> DataFrame:
    tgt = d.sql(S.TGT).withColumn("result", F.lit("ACTIVE"))
    return plain(merge.merge_delete(tgt, d.sql(S.SRC), ["customer_id"], ["last_date"], None))


def verify_guarded(d: Data) -> DataFrame:
    """Each account's newest micro-deposit passes, unless it was verified before."""
    ver = d.sql(S.VER)
    accounts = d.customer.select(F.col("c_custkey").alias("account"))
    newest = lookup.latest(
        accounts, ver, ["account"], [F.col("created_date"), F.col("id")],
        F.col("verification_type") == "MicroDeposit",
    )
    patch = newest.filter(F.col("id").isNotNull() & F.col("verified_date").isNull()).select(
        "id",
        F.expr("created_date + INTERVAL 1 DAY").alias("verified_date"),
        F.lit("Pass").alias("result"),
    )
    out = lookup.update_from(ver, patch, ["id"], ["verified_date", "result"])
    return plain(out.select("id", "result", "verified_date"))


def id_map(d: Data) -> DataFrame:
    """Order-customer pairs; the second pair of ids comes from the order's line items."""
    pairs = d.orders.select(
        F.col("o_orderkey").alias("modern_bank_account_id"),
        F.col("o_custkey").alias("legacy_bank_account_id"),
        F.lit(None).cast("long").alias("modern_micro_deposit_id"),
        F.lit(None).cast("long").alias("legacy_micro_deposit_id"),
    )
    later = d.lineitem.groupBy(F.col("l_orderkey").alias("modern_bank_account_id")).agg(
        F.min("l_partkey").alias("modern_micro_deposit_id"),
        F.max("l_suppkey").alias("legacy_micro_deposit_id"),
    )
    return lookup.update_from(
        pairs, later, ["modern_bank_account_id"],
        ["modern_micro_deposit_id", "legacy_micro_deposit_id"],
    )


def _retyped(d: Data) -> tuple[DataFrame, DataFrame]:
    """Checking accounts of users with a purchase become savings accounts."""
    accounts = d.sql(S.ACCOUNT).select("customer_id", "type_id")
    buyers = d.events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("customer_id")
    )
    hit = lookup.semi(accounts.filter(F.col("type_id") == 1), buyers, ["customer_id"])
    patch = hit.select("customer_id", F.lit(2).alias("type_id"))
    return lookup.update_from(accounts, patch, ["customer_id"], ["type_id"]), patch


def retype_account(d: Data) -> DataFrame:
    return _retyped(d)[0]


def outbox(d: Data) -> DataFrame:
    rows = _retyped(d)[1].withColumn("event_id", C.text("type:", F.col("customer_id")))
    return generate.outbox(rows, codes.OUTBOX_TYPE_CHANGE, account_id="customer_id")


def account_lifecycle(d: Data) -> DataFrame:
    """Rich customers have an account; signing up opens one, a last event of error removes it."""
    stored = d.customer.filter(F.col("c_acctbal") >= 3000).select(
        F.col("c_custkey").alias("user_id"), F.lit("stored").alias("how")
    )
    opened = d.events.filter(F.col("event_type") == "signup").select("user_id").distinct()
    opened = opened.join(stored, ["user_id"], "left_anti").withColumn("how", F.lit("opened"))
    last = lookup.pick_one(
        d.events.select("user_id", "ts", "event_type"), ["user_id"], [F.col("ts")], newest=True
    )
    removed = last.filter(F.col("event_type") == "error")
    return stored.unionByName(opened).join(removed, ["user_id"], "left_anti")


def one_primary(d: Data) -> DataFrame:
    accounts = d.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("account_id"),
        F.col("o_orderkey").alias("born_seq"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_primary"),
    )
    asked = d.orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("account_id"),
        (F.col("o_orderkey") + 500).alias("seq"),
    )
    # An account lives from its order on; orders with status F end it 300 later.
    births = accounts.select(
        "customer_id", "account_id", F.col("born_seq").alias("seq"), F.lit(True).alias("alive")
    )
    deaths = d.orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("account_id"),
        (F.col("o_orderkey") + 300).alias("seq"),
        F.lit(False).alias("alive"),
    )
    valid = merge.valid_promotions(asked, births.unionByName(deaths))
    return merge.one_primary(accounts, valid)


def expand_md(d: Data) -> DataFrame:
    key = "bank_account_verification_id"
    piv = deposits.pivot3(d.sql(S.TXN), key, ["created_date", "id"])
    return generate.expand_md(piv, [key], "mdamount1", "mdamount2")


def cases_audit(d: Data) -> DataFrame:
    ver = d.sql(S.VER)
    passed = route.is_true(F.col("result") == "Pass")
    case_id = generate.assign_ids(F.col("id"), F.lit("case"))
    event = generate.assign_ids(F.lit("order"), F.col("id"))
    ver = ver.withColumns({"event_id": event, "uc_id": case_id})
    cases = generate.open_cases(
        ver,
        uc_id=F.col("uc_id"),
        type_id=F.when(passed, codes.CASE_EWS_ACTIVE).otherwise(codes.CASE_EWS_PENDING),
        open_date="created_date",
        open_agent=F.lit("agent"),
        status_date="created_date",
        status_agent=F.lit("agent"),
        credit_account_id="account",
        card_id=F.lit(None).cast("long"),
    ).select("uc_id", "ref_num", "type_id", "status_id")
    lines = generate.audit_lines(
        ver,
        F.when(passed, "step_up_ok").otherwise("step_up_failed"),
        uc_id=F.col("uc_id"),
        uc_audit_id=generate.assign_ids(F.col("id"), F.lit("audit")),
        audit_date="created_date",
        account=F.col("id").cast("string"),
    )
    # Every case has lines and every line a case: the join shows both tables.
    return plain(lookup.inner(lines, cases, ["uc_id"]))


def dense_ids(d: Data) -> DataFrame:
    """The number of every order, by date and key."""
    orders = d.orders.select("o_orderkey", "o_orderdate")
    out = generate.dense_ids(orders, ["o_orderdate", "o_orderkey"], "dense", Scratch(d.spark), start=100)
    return out.select("o_orderkey", F.col("dense").cast("long").alias("dense"))


def verification_rows(d: Data) -> DataFrame:
    ver = d.sql(S.VER)

    def row(n, kind, made, result):
        return F.struct(
            F.lit(n).alias("row_no"), kind.alias("verification_type"),
            made.alias("created_date"), result.alias("result"),
        )

    step_up = F.when(
        F.col("result") == "StepUp",
        row(1, F.lit("Initial"), F.col("created_date"), F.lit("StepUp")),
    )
    main = row(2, F.col("verification_type"), C.plus_micros("created_date"), F.col("result"))
    return plain(generate.verification_rows(ver, ["id"], [step_up, main]))


def history_rows(d: Data) -> DataFrame:
    acc = d.sql(S.ACCOUNT).withColumn("event_id", F.col("customer_id").cast("string"))
    return generate.history_rows(
        acc, codes.HISTORY_UPDATE,
        customer=F.col("customer_id"), account=F.col("account_number"),
        routing=F.col("routing_number"), account_type_id=F.col("type_id"),
        channel=F.col("segment"),
    )


ORIGIN = """
SELECT event_id,
  CASE event_id % 5 WHEN 0 THEN 'MODERN' WHEN 1 THEN 'LEGACY' END AS origin,
  CASE event_type WHEN 'click' THEN 'CASH' WHEN 'view' THEN NULL ELSE 'Web' END AS channel
FROM {events}
"""


def drop_echo(d: Data) -> DataFrame:
    return route.drop_echo(d.sql(ORIGIN)).select("event_id")


def drop_sentinel(d: Data) -> DataFrame:
    return route.drop_sentinel(route.drop_echo(d.sql(ORIGIN))).select("event_id")


def trace_log(d: Data) -> DataFrame:
    ev = feed(d).filter(F.col("op") == "U")
    log = rejects.trace(
        ev.withColumn("event_id", F.col("event_id").cast("string")),
        "attempt", rejects.LEGACY_TO_MODERN,
        rejects.prefixed_id("attempt", F.col("user_id")),
        C.text("kind_new: ", F.col("after.kind"), " | kind_old: ", F.col("before.kind")),
        now(), failure_count=1,
    )
    return plain(log.drop("updated_by", "updated_timestamp", "trigger_input", "trigger_name"))


QUERIES = {
    "pair_images": pair_images_query,
    "touching": touching_query,
    "touching_changed": touching_changed,
    "transition": transition,
    "route_branches": route_branches,
    "classify_strict": classify_strict,
    "classify_lenient": classify_lenient,
    "classify_lenient_date": classify_lenient_date,
    "recode_types": recode_types,
    "mask_and_text": mask_and_text,
    "stamp_offset": stamp_offset,
    "inner_bank": inner_bank,
    "enrich": enrich,
    "first_match": first_match,
    "latest_verification": latest_verification,
    "same_day": same_day,
    "semi_accounts": semi_accounts,
    "lookup_one": lookup_one,
    "reject_log": reject_log,
    "typed_changes": typed_changes,
    "exists_flag": exists_flag,
    "find_or_create": find_or_create,
    "find_or_create_new": find_or_create_new,
    "update_from": update_from,
    "as_of": as_of,
    "compare_and_set": compare_and_set,
    "attempts": attempts,
    "prior_attempts": prior_attempts,
    "pivot3": pivot3,
    "debit_override": debit_override,
    "merge_upsert": merge_upsert,
    "fold_patches": fold_patches,
    "merge_delete": merge_delete,
    "merge_delete_matched": merge_delete_matched,
    "verify_guarded": verify_guarded,
    "id_map": id_map,
    "retype_account": retype_account,
    "outbox": outbox,
    "account_lifecycle": account_lifecycle,
    "one_primary": one_primary,
    "expand_md": expand_md,
    "cases_audit": cases_audit,
    "dense_ids": dense_ids,
    "verification_rows": verification_rows,
    "history_rows": history_rows,
    "drop_echo": drop_echo,
    "drop_sentinel": drop_sentinel,
    "trace_log": trace_log,
}
