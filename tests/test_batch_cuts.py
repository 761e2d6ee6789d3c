"""One batch or several: what is stored and written must not depend on the cut."""

import random
import uuid
from datetime import timedelta

import pytest
from helpers import DAY, feed, now, rows, tables
from test_legacy_flows import account, target, ver
from test_modern_accounts import add, update

from duosync.operators.generate import MOST_SEQ
from duosync.plans.batch import run_batch
from duosync.plans.lineage import checkpoint_folder
from duosync.streaming.stream import TableStore, process_batch, union_feeds

LATER = DAY + timedelta(days=1)


def tried(seq, lock, **more):
    new = {"id": seq, "verification_locking_id": lock, "channel": "Web"}
    return {"seq": seq, "op": "I", "new": new, **more}


def proved(seq, customer):
    old = ver(customer, result="StepUp", verification_type="MicroDeposit")
    new = {**old, "verified_date": LATER, "result": "Pass"}
    return {"seq": seq, "op": "U", "old": old, "new": new, "cols": ["verified_date", "result"]}


def in_parts(spark, feeds, start, cuts):
    """Run batch by batch; returns the last tables and all outputs."""
    t, outputs, low = start, {}, 0
    for high in [*cuts, 1 << 40]:
        part = {n: f.filter(f"seq >= {low} AND seq < {high}") for n, f in feeds.items()}
        part = {n: f for n, f in part.items() if not f.isEmpty()}
        if part:
            done = run_batch(part, t, now())
            t = {n: spark.createDataFrame(df.collect(), df.schema) for n, df in done.tables.items()}
            for name, df in done.outputs.items():
                outputs.setdefault(name, []).extend(map(str, df.collect()))
            done.release()
        low = high
    return t, {n: sorted(o) for n, o in outputs.items() if o}


def state(t):
    drop = [c for c in t["target"].columns if c.startswith("_")]
    out = {n: sorted(map(str, df.collect())) for n, df in t.items() if n != "target"}
    return out | {"target": sorted(map(str, t["target"].drop(*drop).collect()))}


def attempts_world(spark):
    return tables(
        spark,
        credit_account=[{"credit_account_id": n + 1000, "customer_id": n} for n in (2, 3)],
        bank_account=[
            {"id": n, "aba_number": "R1", "account_number": f"ACCOUNT{n}", "account_type": "Savings"}
            for n in (2, 3)
        ],
        customer_account=[account(n, account_type_id=2) for n in (2, 3)],
        verification=[ver(2, verification_type="MicroDeposit", result="StepUp"), ver(3)],
        lock=[{"id": n, "bank_account_verification_id": n} for n in (2, 3)],
        attempt=[{"id": 500 + n, "verification_locking_id": 2} for n in range(3)],
        target=[target(n) for n in (2, 3)],
    )


def test_attempts_after_the_verification_do_not_count(spark):
    feeds = {
        "verification": feed(spark, "verification", [proved(1, 2)]),
        "attempt": feed(spark, "attempt", [tried(2, 3)]),
    }
    world = attempts_world(spark)
    once, _ = in_parts(spark, feeds, world, [])
    (row,) = [r for r in rows(once["target"]) if r["legacy_customer_id"] == 2]
    assert (row["locked"], row["verification_attempts"]) == ("Y", 3)
    # A fourth attempt on the same lock: the verification event, being earlier, sees three.
    feeds["attempt"] = feed(spark, "attempt", [tried(2, 2)])
    before, _ = in_parts(spark, {"verification": feeds["verification"]}, world, [])
    (want,) = [r for r in rows(before["target"]) if r["legacy_customer_id"] == 2]
    from duosync.plans import legacy_side as legacy

    found = legacy.enrich_verifications(
        feeds["verification"], world, committed=world["attempt"], made=feeds["attempt"]
    )
    assert [r.attempts for r in found.collect()] == [3] == [want["verification_attempts"]]


@pytest.mark.parametrize("seed", [1])
def test_random_cuts(spark, seed):
    rng = random.Random(seed)
    tries = [tried(s, rng.choice([2, 3])) for s in rng.sample(range(1, 30), 6)]
    feeds = {
        "verification": feed(spark, "verification", [proved(40 + rng.randrange(5), 2)]),
        "attempt": feed(spark, "attempt", tries + [tried(60, 2)]),
    }
    world = attempts_world(spark)
    once = in_parts(spark, feeds, world, [])
    cuts = sorted(rng.sample(range(1, 62), 2))
    several = in_parts(spark, feeds, world, cuts)
    assert state(several[0]) == state(once[0]), cuts
    assert several[1] == once[1], cuts


def test_an_attempt_sees_the_verification_before_it(spark):
    """The attempt comes before the modern side verifies; the target keeps the state of that time."""
    event = proved(5, 2)
    old = {**event["old"], "is_migrated": 2}
    event.update(old=old, new={**event["new"], "is_migrated": 2}, origin="MODERN")
    feeds = {
        "verification": feed(spark, "verification", [event]),
        "attempt": feed(spark, "attempt", [tried(1, 2)]),
    }
    world = attempts_world(spark)
    world["verification"] = tables(spark, verification=[old])["verification"]
    once, _ = in_parts(spark, feeds, world, [])
    (row,) = [r for r in rows(once["target"]) if r["legacy_customer_id"] == 2]
    assert (row["result"], row["verified_date"]) == ("PENDING_ACH_VALIDATION", None)
    assert state(in_parts(spark, feeds, world, [3])[0]) == state(once)


@pytest.mark.parametrize("seed", [4])
def test_random_cuts_over_deposits_and_accounts(spark, seed):
    """Statuses and new rows of transactions, and accounts that come, change and go."""
    rng = random.Random(seed)
    places = iter(rng.sample(range(1, 200), 40))
    migrated = [ver(2, is_migrated=2), ver(3, verification_type="MicroDeposit", result="StepUp")]
    world = attempts_world(spark) | {
        n: df
        for n, df in tables(
            spark,
            verification=migrated,
            transaction=[
                txn(10 * n + k, bank_account_verification_id=n, created_date=DAY + timedelta(hours=k))
                for n in (2, 3) for k in range(2 + n)
            ],
        ).items()
        if n in ("verification", "transaction")
    }

    def changed(n, k, status):
        old = txn(10 * n + k, bank_account_verification_id=n, created_date=DAY + timedelta(hours=k))
        return {"seq": next(places), "op": "U", "old": old, "new": {**old, "status": status}, "cols": ["status"]}

    late = txn(900, bank_account_verification_id=2, status="Received", created_date=DAY)
    extra = account(2, account_type_id=1, is_primary=1)
    extra["customer_bank_account_id"] = 777
    verified = [ver(n, **more) for n, more in ((2, {"is_migrated": 2}), (3, {"verification_type": "MicroDeposit"}))]
    feeds = {
        "transaction": feed(spark, "transaction", [
            *[changed(n, k, f"S{i}") for i, (n, k) in enumerate([(2, 0), (2, 1), (3, 0), (2, 0), (3, 2)])],
            {"seq": next(places), "op": "I", "new": late},
        ]),
        "customer_account": feed(spark, "customer_account", [
            {"seq": next(places), "op": "U", "old": account(2), "new": account(2, is_primary=1)},
            {"seq": next(places), "op": "U", "old": account(2), "new": account(2, is_primary=0)},
            {"seq": next(places), "op": "D", "old": account(3)},
            {"seq": next(places), "op": "I", "new": extra},
        ]),
        "verification": feed(spark, "verification", [
            {"seq": next(places), "op": "U", "old": {**v, "verified_date": None},
             "new": {**v, "verified_date": LATER}, "cols": ["verified_date"]}
            for v in verified for _ in range(2)
        ]),
        "attempt": feed(spark, "attempt", [tried(next(places), n) for n in (2, 3, 2)]),
    }
    once = in_parts(spark, feeds, world, [])
    several = in_parts(spark, feeds, world, sorted(rng.sample(range(1, 200), 2)))
    assert state(several[0]) == state(once[0])
    assert several[1] == once[1]


def txn(n, **more):
    return {"id": n, "bank_account_verification_id": 2, "status": "Created",
            "accounting_transaction_type": "Credit", "amount": None, **more}


def posting_feeds(spark):
    deposit = {
        "stage_sequence_id": 1, "modern_bank_account_id": 2, "legacy_customer_id": 2,
        "routing_number": "R1", "account_number": "ACCOUNT2", "account_type": "SAV",
        "updated_timestamp": DAY,
    }
    return {
        "modern_deposit": feed(spark, "modern_deposit", [
            {"seq": 1, "op": "U", "old": {**deposit, "md_status": "InProgress"},
             "new": {**deposit, "md_status": "Processed"}},
        ]),
        "transaction": feed(spark, "transaction", [
            {"seq": 2, "op": "U", "old": txn(7), "new": txn(7, status="Returned")},
        ]),
    }


def test_posting_then_a_later_status(spark):
    world = tables(
        spark,
        bank_account=[{"id": 2, "aba_number": "R1", "account_number": "ACCOUNT2", "account_type": "Savings"}],
        modern_account=[{"stage_sequence_id": 1, "modern_bank_account_id": 2, "credit_account_id": 1002}],
        verification=[ver(2, is_migrated=2, verification_type="MicroDeposit", bank_account_id=2)],
        transaction=[txn(7), txn(8)],
    )
    once = in_parts(spark, posting_feeds(spark), world, [])
    assert {r["id"]: r["status"] for r in rows(once[0]["transaction"])} == {7: "Returned", 8: "Processed"}
    assert state(in_parts(spark, posting_feeds(spark), world, [2])[0]) == state(once[0])


def test_late_images_lose(spark):
    old = account(2, is_primary=0)
    def event(seq, op, **new):
        return feed(spark, "customer_account", [{"seq": seq, "op": op, "old": old, **({"new": {**old, **new}} if op == "U" else {})}])

    world = tables(spark, customer_account=[old, account(3)])
    first = run_batch({"customer_account": event(9, "U", is_primary=1)}, world, now()).tables
    second = run_batch({"customer_account": event(3, "U", is_primary=0)}, first, now()).tables
    flags = {r["customer_id"]: r["is_primary"] for r in rows(second["customer_account"])}
    assert flags[2] == 1
    gone = run_batch({"customer_account": event(12, "D")}, second, now()).tables
    late = run_batch({"customer_account": event(11, "U", is_primary=0)}, gone, now()).tables
    assert [r["customer_id"] for r in rows(late["customer_account"])] == [3]


def test_type_change_then_removal(spark):
    """Both events count, whatever else is in the batch."""
    stored = account(2, account_type_id=2)
    bank = {"id": 2, "aba_number": stored["routing_number"], "account_number": stored["account_number"], "account_type": "Savings"}
    world = tables(spark, customer_account=[stored], bank_account=[bank],
                   credit_account=[{"credit_account_id": 1002, "customer_id": 2}])
    events = [
        update(2, {"account_type": "SAV"}, seq=1, account_type="CHK"),
        update(2, {"account_type": "CHK", "operation_type": "UPDATE"}, seq=2, account_type="CHK", operation_type="DELETE"),
    ]
    done = run_batch({"modern_account": feed(spark, "modern_account", events)}, world, now())
    assert len(rows(done.outputs["history"])) == 2
    assert rows(done.tables["customer_account"]) == []


def test_unsound_events_are_rejected(spark):
    events = [tried(1, 2, id=None), tried(2, 2, id=None), tried(MOST_SEQ + 1, 2), tried(3, 2)]
    wide = union_feeds({"attempt": feed(spark, "attempt", events)})
    root = f"{checkpoint_folder(spark)}/unsound-{uuid.uuid4().hex}"
    store = TableStore(spark, f"{root}/tables", buckets=2)
    store.create(attempts_world(spark))
    process_batch(wide, 0, store, f"{root}/out", now=now)
    log = rows(spark.read.parquet(f"{root}/out/log"))
    assert sum(r["failure_reason"] == "EVENT_WITHOUT_ID_OR_NUMBER" for r in log) == 3
    assert store.load()["attempt"].count() == 4


def test_stream_store(spark):
    """Deletes that empty buckets, redelivered events, and replays."""
    root = f"{checkpoint_folder(spark)}/cuts-{uuid.uuid4().hex}"
    store = TableStore(spark, f"{root}/tables", buckets=16)
    store.create(attempts_world(spark))
    gone = union_feeds({"customer_account": feed(spark, "customer_account", [
        {"seq": 1, "op": "D", "old": account(2, account_type_id=2)},
        {"seq": 2, "op": "D", "old": account(3, account_type_id=2)},
    ])})
    for _ in range(2):  # the second time it is a replay
        process_batch(gone, 0, store, f"{root}/out", now=now)
        assert rows(store.load()["customer_account"]) == []
    more = union_feeds({"attempt": feed(spark, "attempt", [tried(5, 3)])})
    process_batch(more, 1, store, f"{root}/out", now=now)
    before = {n: sorted(map(str, df.collect())) for n, df in store.load().items()}
    written = spark.read.parquet(f"{root}/out/log").count()
    # The same event in a later batch, beside a new one.
    both = union_feeds({"attempt": feed(spark, "attempt", [tried(5, 3), tried(6, 2)])})
    process_batch(both, 2, store, f"{root}/out", now=now)
    after = {n: sorted(map(str, df.collect())) for n, df in store.load().items()}
    assert len(after["attempt"]) == len(before["attempt"]) + 1
    process_batch(more, 3, store, f"{root}/out", now=now)
    assert {n: sorted(map(str, df.collect())) for n, df in store.load().items()} == after
    assert spark.read.parquet(f"{root}/out/log").count() >= written
    from duosync.plans.lineage import path_exists

    assert not path_exists(spark, f"{root}/tables/_staging/batch_2")


def test_rejected_events_leave_no_trace(spark):
    """A verification that isn't found rejects the event, and its type change with it."""
    stored = account(2, account_type_id=2)
    bank = {"id": 2, "aba_number": stored["routing_number"], "account_number": stored["account_number"], "account_type": "Savings"}
    world = tables(spark, customer_account=[stored], bank_account=[bank],
                   credit_account=[{"credit_account_id": 1002, "customer_id": 2}])
    from test_modern_accounts import PROVE

    events = [
        update(2, {**PROVE, "account_type": "SAV"}, seq=1, account_type="CHK"),
        update(2, {"account_type": "SAV"}, seq=2, account_type="SAV", operation_type="DELETE"),
    ]
    done = run_batch({"modern_account": feed(spark, "modern_account", events)}, world, now())
    assert rows(done.tables["customer_account"]) == []
    assert add is not None
