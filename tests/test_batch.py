"""Whole batches: echo suppression, batch splits, replays, and the stream."""

import uuid
from datetime import timedelta

import pytest
from helpers import DAY, feed, now, rows, tables
from pyspark.sql import functions as F
from test_legacy_flows import account, target, ver
from test_modern_accounts import PROVE, add, update
from test_modern_deposits import start

from duosync.operators.generate import SLOTS
from duosync.plans.batch import run_batch
from duosync.plans.lineage import checkpoint_folder
from duosync.sources.schemas import FEEDS, envelope
from duosync.streaming.stream import TableStore, process_batch, run_stream, split_feeds, union_feeds


def new_id(seq, slot):
    return -(seq * 32 + SLOTS[slot] + 1)


def world(spark):
    ids = (2, 3, 4, 30, 31)
    return tables(
        spark,
        credit_account=[{"credit_account_id": n + 1000, "customer_id": n} for n in (2, 3, 4, 11, 30, 31)],
        bank_account=[{"id": n, "aba_number": "R1", "account_number": f"ACCOUNT{n}",
                       "account_type": "Savings"} for n in (2, 3, 4, 11, 30, 31)],
        customer_account=[account(n, account_type_id=2) for n in (2, 3, 4)],
        verification=[ver(2), ver(3, is_migrated=2), ver(4, is_migrated=2), ver(11, is_migrated=2, credit_account_id=1011),
                      ver(30), ver(31, is_migrated=2)],
        lock=[{"id": n, "bank_account_verification_id": n} for n in ids],
        attempt=[{"id": 500, "verification_locking_id": 30}],
        target=[target(n, is_primary=0) for n in (2, 3, 30)],
    )


def tried(seq, lock):
    return {"seq": seq, "op": "I", "new": {"id": seq, "verification_locking_id": lock, "channel": "Web"}}


def feeds(spark):
    return {
        "modern_account": feed(spark, "modern_account", [
            add(1, verification_type="AGENT"),
            update(2, {"is_primary": 0}, operation_type="PRIMARY_UPDATE", is_primary=1),
            update(3, {"is_primary": 0}, operation_type="PRIMARY_UPDATE", is_primary=1),
            update(4, {"is_primary": 0}, operation_type="PRIMARY_UPDATE", is_primary=1),
            update(11, PROVE),
        ]),
        "modern_deposit": feed(spark, "modern_deposit", [start(1, seq=12, account_type="SAV")]),
        "attempt": feed(spark, "attempt", [tried(20, 30), tried(21, 30), tried(22, 31), tried(23, 31)]),
        "customer_account": feed(spark, "customer_account", [
            {"seq": 24, "op": "U", "new": account(3, account_type_id=1), "old": account(3, account_type_id=2)},
        ]),
    }


def target_rows(df):
    return {r["legacy_customer_id"]: r for r in rows(df)}


@pytest.fixture(scope="module")
def result(spark):
    res = run_batch(feeds(spark), world(spark), now())
    got = {n: rows(df) for n, df in res.outputs.items()}
    got["target"] = target_rows(res.tables["target"])
    got["tables"] = {n: rows(res.tables[n]) for n in ("verification", "customer_account", "id_map", "bank_account", "transaction")}
    res.release()
    return got


def test_migrated_changes_do_not_echo(result):
    # The new account's own insert comes back to the legacy flow and changes nothing.
    assert 1 not in result["target"] and 4 not in result["target"]
    traces = [r["failure_reason"] for r in result["log"] if r["event_id"].startswith("account:4:")]
    assert len(traces) == 1 and traces[0].endswith("Flag:True")
    verified = [r for r in result["log"] if r["event_id"] == "modern_account-11:verification"]
    assert [r["kind"] for r in verified] == ["trace"] and 11 not in result["target"]


def test_modern_switch_of_a_legacy_account_is_patched(result):
    assert result["target"][2]["is_primary"] == 1 and result["target"][2]["result"] == "OLD"


def test_legacy_change_of_a_migrated_account_is_merged(result):
    row = result["target"][3]
    assert row["account_type"] == "CHK" and row["result"] == "PENDING_ACH_VALIDATION"
    # The legacy change came after the modern switch and carries its own flag.
    assert row["is_primary"] == 0


def test_deposit_sees_the_bank_account_of_the_same_batch(result):
    started = [v for v in result["tables"]["verification"] if v["bank_account_verification_id"] == new_id(12, "verification")]
    assert started[0]["bank_account_id"] == new_id(1, "bank")
    assert sum(t["accounting_transaction_type"] == "Credit" for t in result["tables"]["transaction"]) == 2
    (pair,) = [m for m in result["tables"]["id_map"] if m["modern_bank_account_id"] == 1]
    assert pair["legacy_micro_deposit_id"] == new_id(12, "verification")


def test_verified_by_modern(result):
    (row,) = [v for v in result["tables"]["verification"] if v["bank_account_verification_id"] == 11]
    assert row["result"] == "Pass" and row["verified_date"] == DAY + timedelta(days=1)


def test_attempts_count_on(result):
    assert (result["target"][30]["locked"], result["target"][30]["verification_attempts"]) == ("Y", 3)
    assert (result["target"][31]["locked"], result["target"][31]["verification_attempts"]) == ("N", 2)


def part(frames, keep):
    return {n: df.filter(keep) for n, df in frames.items()}


def test_two_batches_give_the_same_state(spark, result):
    first = run_batch(part(feeds(spark), "seq < 22 AND seq <> 11"), world(spark), now())
    second = run_batch(part(feeds(spark), "seq >= 22 OR seq = 11"), first.tables, now())
    got = target_rows(second.tables["target"])
    for customer, row in result["target"].items():
        for col, value in row.items():
            if not col.startswith("_"):
                assert got[customer][col] == value, (customer, col)
    assert set(got) == set(result["target"])


def flat(df):
    return sorted(str(sorted(r.items(), key=str)) for r in rows(df.drop("batch_id")))


@pytest.fixture(scope="module")
def root(spark):
    return f"{checkpoint_folder(spark)}/test-{uuid.uuid4().hex}"


def test_stream_equals_batch_and_replays(spark, root, result):
    paths = {}
    for name, df in feeds(spark).items():
        paths[name] = f"{root}/feeds/{name}"
        df.write.parquet(paths[name])
    store = TableStore(spark, f"{root}/tables", buckets=3)
    store.create(world(spark))
    run_stream(spark, paths, store, f"{root}/out", f"{root}/checkpoint", now=now).awaitTermination()
    assert target_rows(store.load()["target"]) == result["target"]
    for name in ("verification", "customer_account", "id_map", "bank_account", "transaction"):
        assert sorted(map(str, rows(store.load()[name]))) == sorted(map(str, result["tables"][name])), name
    audits = spark.read.parquet(f"{root}/out/audit").drop("batch_id")
    want = sorted(str(sorted(r.items())) for r in result["audit"])
    assert sorted(str(sorted(r.items())) for r in rows(audits)) == want
    # The same batch again: its staged files are published once more, nothing is run.
    before = {n: flat(df) for n, df in store.load().items()}
    process_batch(union_feeds(feeds(spark)), 0, store, f"{root}/out", now=now)
    assert {n: flat(df) for n, df in store.load().items()} == before


def test_unpublished_batch_is_completed(spark, root):
    """Lost between staging and publishing: the repeated batch completes it."""
    store = TableStore(spark, f"{root}/tables2", buckets=3)
    store.create(world(spark))
    wide = union_feeds({"attempt": feed(spark, "attempt", [tried(20, 30)])})
    publish, store.publish = store.publish, lambda batch_id: None
    process_batch(wide, 7, store, f"{root}/out2", now=now)
    assert target_rows(store.load()["target"])[30]["verification_attempts"] is None
    store.publish = publish
    process_batch(wide, 7, store, f"{root}/out2", now=now)
    assert target_rows(store.load()["target"])[30]["verification_attempts"] == 2


def test_feeds_survive_the_union(spark):
    frames = feeds(spark)
    back = split_feeds(union_feeds(frames), frames)
    for name, df in frames.items():
        assert back[name].schema == envelope(FEEDS[name])
        assert flat(back[name]) == flat(df)


def test_errors_survive_the_union(spark):
    frames = feeds(spark)
    first = min(frames)
    frames[first] = frames[first].withColumn("error", F.lit("bad"))
    back = split_feeds(union_feeds(frames), frames)
    for name, df in back.items():
        assert {r.error for r in df.select("error").collect()} <= ({"bad"} if name == first else {None})
    assert back[first].filter("error = 'bad'").count() == frames[first].count()


def test_strict_keys_reject(spark):
    t = tables(spark)
    ev = {"attempt": feed(spark, "attempt", [tried(1, 99)])}
    loose = run_batch(ev, t, now())
    assert loose.tables["target"].count() == 1
    strict = run_batch(ev, t, now(), strict_keys=True)
    assert strict.tables["target"].count() == 0
    assert [r["failure_reason"] for r in rows(strict.outputs["log"]) if r["kind"] == "reject"] == ["NULL_TARGET_KEY"]
