"""Events that end in an error cost one log row each, and all others go on."""

import uuid
from decimal import Decimal

from helpers import DAY, feed, now, rows
from test_batch import tried, world
from test_modern_accounts import add
from test_modern_deposits import start

from duosync.plans.batch import BAD_AMOUNT, BAD_TIME, run_batch
from duosync.plans.lineage import checkpoint_folder
from duosync.sources.feeds import text_images, typed_changes
from duosync.sources.schemas import FEEDS, schema
from duosync.streaming.stream import TableStore, run_stream

MOST = Decimal("9999999999999999.99")


def texts(values, ddl):
    return tuple(values.get(f.name) for f in schema(ddl).fields)


def raw_attempts(spark, events):
    row = schema(FEEDS["attempt"])
    data = [(e, s, "I", None, None, None, texts(v, FEEDS["attempt"])) for e, s, v in events]
    return spark.createDataFrame(data, text_images(row)), row


ATTEMPTS = [
    ("a", "20", {"id": "20", "verification_locking_id": "30", "created_date": "2024-06-01 09:00:00"}),
    ("b", "21", {"id": "x", "verification_locking_id": "30", "created_date": "June"}),
    ("c", "no", {"id": "22", "verification_locking_id": "30"}),
    ("d", "23", {"id": "99999999999999999999", "verification_locking_id": "30"}),
    ("e", "24", {"id": "24", "verification_locking_id": "30", "channel": "Web"}),
]


def test_texts_that_types_cannot_hold(spark):
    raw, row = raw_attempts(spark, ATTEMPTS)
    got = {r["event_id"]: r for r in rows(typed_changes(raw, row))}
    assert {e: r["error"] for e, r in got.items()} == {
        "a": None,
        "b": "BAD_VALUE: after.id, after.created_date",
        "c": "BAD_VALUE: seq",
        "d": "BAD_VALUE: after.id",
        "e": None,
    }
    assert got["a"]["after"]["created_date"] == DAY and got["a"]["before"] is None
    assert got["b"]["after"]["verification_locking_id"] == 30 and got["b"]["after"]["id"] is None
    assert typed_changes(raw.limit(0), row).count() == 0


def test_a_stream_of_texts(spark):
    root = f"{checkpoint_folder(spark)}/texts-{uuid.uuid4().hex}"
    store = TableStore(spark, f"{root}/tables", buckets=2)
    store.create(world(spark))
    raw, _ = raw_attempts(spark, ATTEMPTS)
    raw.write.parquet(f"{root}/attempt")
    query = run_stream(
        spark, {"attempt": f"{root}/attempt"}, store, f"{root}/out", f"{root}/checkpoint", texts=True, now=now
    )
    query.awaitTermination()
    log = {r["event_id"]: r for r in rows(spark.read.parquet(f"{root}/out/log"))}
    assert {e: r["failure_reason"] for e, r in log.items() if r["kind"] == "reject"} == {
        "b": "BAD_VALUE: after.id, after.created_date",
        "c": "BAD_VALUE: seq",
        "d": "BAD_VALUE: after.id",
    }
    assert {r["id"] for r in rows(store.load()["attempt"])} == {500, 20, 24}


def test_overflows_among_good_events(spark):
    deposits = feed(spark, "modern_deposit", [
        start(1, seq=12, account_type="SAV"),
        start(2, seq=13, account_type="SAV", mdamount1=MOST, mdamount2=MOST),
        start(3, seq=14, account_type="SAV", mdamount1=MOST, mdamount2=None),
    ])
    accounts = feed(spark, "modern_account", [add(1, seq=1), add(5, seq=5)])
    # The last instant a time can hold; Python has none so late.
    at = "timestamp_micros(9223372036854775807)"
    accounts = accounts.selectExpr(
        "event_id", "seq", "op", "origin", "updated_cols", "before",
        "CASE WHEN seq = 5 THEN named_struct("
        + ", ".join(
            f"'{f.name}', {at if f.name == 'created_timestamp' else 'after.' + f.name}"
            for f in schema(FEEDS["modern_account"]).fields
        )
        + ") ELSE after END AS after",
    )
    tries = feed(spark, "attempt", [tried(20, 30)])
    done = run_batch({"modern_deposit": deposits, "modern_account": accounts, "attempt": tries}, world(spark), now())
    failed = {r["event_id"]: r["failure_reason"] for r in rows(done.outputs["log"]) if r["kind"] == "reject"}
    assert failed["modern_deposit-13"] == BAD_AMOUNT and failed["modern_account-5"] == BAD_TIME
    assert "modern_deposit-12" not in failed and "modern_account-1" not in failed
    # The row is stored, but nothing comes of it.
    assert {71, 72, 73} <= {r["md_id"] for r in done.tables["modern_deposit"].select("md_id").collect()}
    made = {r["seq"] for r in rows(done.tables["applied"].filter("feed = 'modern_deposit'"))}
    assert made == {12, 13, 14}
    refs = {r["ref_num"] for r in rows(done.outputs["case"])}
    assert "modern_account-1" in refs and not refs & {"modern_deposit-13", "modern_account-5"}
    assert {500, 20} <= {r["id"] for r in done.tables["attempt"].select("id").collect()}
    done.release()
