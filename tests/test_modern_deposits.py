"""Branch scenarios of the micro-deposit flow."""

from datetime import timedelta
from decimal import Decimal

import pytest
from helpers import DAY, feed, now, rows, tables

from duosync.operators.generate import SLOTS
from duosync.plans import modern_side as M
from duosync.plans.lineage import Scratch

LATER = DAY + timedelta(days=1)
COLS = ["md_status", "verification_attempts", "locked"]


def new_id(seq, slot):
    return -(seq * 32 + SLOTS[slot] + 1)


def image(n, **values):
    return {
        "stage_sequence_id": n, "md_id": n + 70, "modern_bank_account_id": n,
        "legacy_customer_id": n, "routing_number": "R1", "account_number": f"ACCOUNT{n}",
        "account_type": "CHK", "md_status": "InProgress", "mdamount1": Decimal("0.11"),
        "mdamount2": Decimal("0.25"), "verification_attempts": 0, "locked": "0",
        "channel": "WEB", "created_timestamp": DAY, "updated_timestamp": LATER, **values,
    }


def start(n, seq=None, **values):
    return {"seq": seq or n, "op": "I", "new": image(n, **values)}


def update(n, old, seq=None, **values):
    return {"seq": seq or n, "op": "U", "new": image(n, **values), "old": image(n, **{**values, **old}), "cols": COLS}


EVENTS = [
    start(1),
    start(2, md_status="Processed"),
    start(3, mdamount2=None),
    update(4, {"md_status": "InProgress"}, md_status="Processed"),
    update(5, {"md_status": "InProgress"}, md_status="Cancel"),
    update(6, {"verification_attempts": 0}, seq=61, verification_attempts=1),
    update(6, {"verification_attempts": 1}, seq=62, verification_attempts=2),
    update(7, {"verification_attempts": 1}, verification_attempts=1),
    update(8, {"verification_attempts": None}, verification_attempts=1),
    update(9, {"locked": "0"}, locked="1"),
    update(10, {"verification_attempts": 0}, verification_attempts=1),
    update(11, {"verification_attempts": 0}, verification_attempts=1),
    # Started and posted in one batch; started twice is ambiguous.
    start(12, seq=121),
    update(12, {"md_status": "InProgress"}, seq=122, md_status="Processed"),
    start(13, seq=131),
    start(13, seq=132),
    update(13, {"md_status": "InProgress"}, seq=133, md_status="Processed"),
    {**update(14, {"verification_attempts": 0}, verification_attempts=1), "cols": ["channel"]},
]


@pytest.fixture(scope="module")
def out(spark):
    ids = range(1, 15)
    t = tables(
        spark,
        modern_account=[{"stage_sequence_id": n, "modern_bank_account_id": n,
                         "credit_account_id": n + 1000} for n in ids],
        bank_account=[{"id": n, "aba_number": "R1", "account_number": f"ACCOUNT{n}",
                       "account_type": "Checking"} for n in ids],
        user=[{"id": n, "individual_identifier": n, "identifier_type": 2} for n in ids],
        card=[{"card_id": 9, "credit_account_id": 1001, "current_card": 1}],
        verification=[
            {"bank_account_verification_id": n, "verification_type": "MicroDeposit",
             "is_migrated": 2, "bank_account_id": n, "credit_account_id": n + 1000,
             "work_case_id": n + 500}
            for n in (4, 5, 6, 7, 8, 9, 11, 14)
        ],
        lock=[{"id": 77, "bank_account_verification_id": 11}],
        transaction=[{"id": i, "bank_account_verification_id": 4, "status": "Received",
                      "created_date": DAY} for i in (1, 2)],
        deposit_verification=[{"bank_account_verification_id": n} for n in (4, 5)],
    )
    cut = Scratch(spark)
    ev = feed(spark, "modern_deposit", EVENTS)
    res = M.apply_modern_deposits(
        ev, t, now(), mask=False, enriched=cut(M.enrich_deposits(ev, t, cut))
    )
    got = {n: rows(df) for n, df in res.items()}
    got["after"] = {n: rows(df) for n, df in M.deposit_tables(t, res).items()}
    cut.release()
    return got


def audits(out, uc):
    lines = sorted((a for a in out["audit"] if a["uc_id"] == uc), key=lambda a: a["line_no"])
    return [a["data"] for a in lines]


def test_start(out):
    (case,) = [c for c in out["case"] if c["uc_id"] == new_id(1, "case")]
    assert (case["status_id"], case["type_id"], case["open_agent_id"], case["card_id"]) == (26, 415470, "1", 9)
    assert len(audits(out, new_id(1, "case"))) == 4
    (ver,) = [v for v in out["verification"] if v["bank_account_id"] == 1]
    assert (ver["agent"], ver["channel"], ver["result"], ver["is_migrated"]) == ("640", "Web", None, 2)
    txn = sorted((t for t in out["transaction"] if t["bank_account_verification_id"] == new_id(1, "verification")), key=lambda t: t["id"])
    assert [t["accounting_transaction_type"] for t in txn] == ["Credit", "Credit", "Debit"]
    assert [t["amount"] for t in txn] == [Decimal("0.11"), Decimal("0.25"), Decimal("0.36")]
    patch = {p["modern_bank_account_id"]: p for p in out["id_map_patch"]}
    assert patch[1]["modern_micro_deposit_id"] == 71
    assert patch[1]["legacy_micro_deposit_id"] == new_id(1, "verification")


def test_start_needs_progress_and_null_amount_stays_null(out):
    assert not [v for v in out["verification"] if v["bank_account_id"] == 2]
    txn = [t for t in out["transaction"] if t["bank_account_verification_id"] == new_id(3, "verification")]
    assert [t["amount"] for t in txn if t["accounting_transaction_type"] == "Debit"] == [None]


def test_posting_and_cancel(out):
    after = {r["bank_account_verification_id"]: r for r in out["after"]["deposit_verification"]}
    assert after[4]["ach_posted_date"] == LATER and after[4]["canceled_date"] is None
    assert after[5]["canceled_date"] == LATER and after[5]["ach_posted_date"] is None
    txn = [t for t in out["after"]["transaction"] if t["bank_account_verification_id"] == 4]
    assert {(t["status"], t["post_date"]) for t in txn} == {("Processed", LATER)}


def test_attempts_share_one_lock(out):
    locks = [r for r in out["lock"] if r["bank_account_verification_id"] == 6]
    assert [r["id"] for r in locks] == [new_id(61, "lock")]
    mine = [a for a in out["attempt"] if a["verification_locking_id"] == new_id(61, "lock")]
    assert len(mine) == 2 and {a["channel"] for a in mine} == {"Web"}
    assert len(audits(out, 506)) == 6
    assert [a["verification_locking_id"] for a in out["attempt"] if a["verification_locking_id"] == 77] == [77]


@pytest.mark.parametrize("n", [7, 8, 14])
def test_no_attempt(out, n):
    assert audits(out, n + 500) == []


def test_lock_and_reject(out):
    assert audits(out, 509) == ["Verification Status Update: ERROR", "STATUS CHANGED TO ERRCLOSED"]
    reasons = {r["event_id"]: r["failure_reason"] for r in out["log"]}
    assert reasons == {
        "modern_deposit-10": "Bank Account Verification Id is Null",
        "modern_deposit-133": M.AMBIGUOUS_VERIFICATION,
    }


def test_update_sees_start_of_same_batch(out):
    txn = [t for t in out["after"]["transaction"] if t["bank_account_verification_id"] == new_id(121, "verification")]
    assert [t["status"] for t in txn] == ["Processed"] * 3
