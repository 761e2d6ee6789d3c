"""Branch scenarios of the four flows from the legacy side."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import DAY, NOON, feed, now, rows, tables

from duosync.functions.columns import DEFAULT_ZONE
from duosync.operators.merge import apply_patches
from duosync.plans import legacy_side as L
from duosync.plans.target import SHAPE

LOCAL = datetime(2024, 7, 1, 5, 0, 0)
CHANGED = LOCAL + timedelta(microseconds=11)
assert DEFAULT_ZONE == "America/Los_Angeles"


def account(n, **values):
    return {
        "customer_bank_account_id": n, "customer_id": n, "routing_number": "R1",
        "account_number": f"ACCOUNT{n}", "account_type_id": 1, "is_primary": 0,
        "created_date": DAY + timedelta(hours=3), **values,
    }


def ver(n, **values):
    return {
        "bank_account_verification_id": n, "verification_type": "MicroDeposit",
        "created_date": DAY, "agent": "A", "channel": "Web", "credit_account_id": n + 1000,
        "is_migrated": 1, "bank_account_id": n, "user_id": n, **values,
    }


def world(spark, ids, **more):
    base = {
        "credit_account": [{"credit_account_id": n + 1000, "customer_id": n} for n in ids],
        "bank_account": [{"id": n, "aba_number": "R1", "account_number": f"ACCOUNT{n}",
                          "account_type": "Checking"} for n in ids],
    }
    return tables(spark, **{**base, **more})


def target(n, **values):
    return {
        "legacy_customer_id": n, "routing_number": "R1", "account_number": f"ACCOUNT{n}",
        "account_type": "SAV", "result": "OLD", "created_by": "X", **values,
    }


def merged(res, t):
    out = rows(apply_patches(t["target"], res["patches"], SHAPE))
    return {(r["legacy_customer_id"], r["account_number"]): r for r in out}, rows(res["log"])


# --------------------------------------------------------------------------- customer accounts


@pytest.fixture(scope="module")
def customer(spark):
    ids = list(range(1, 20))
    t = world(
        spark, ids,
        verification=[
            ver(1), ver(2, is_migrated=2), ver(3, is_migrated=None),
            ver(4), ver(5, is_migrated=2), ver(7, is_migrated=2), ver(8),
            ver(9, is_migrated=2), ver(10, is_migrated=2), ver(11, is_migrated=2), ver(12),
            # Newest on the day wins; other days and other results do not count.
            ver(13, result="Pass", verification_type="Ews", verified_date=DAY),
            {**ver(130, result="Pass", verification_type="Yodlee", created_date=DAY + timedelta(hours=5)),
             "bank_account_id": 13, "credit_account_id": 1013},
            {**ver(131, result="Pass", created_date=DAY + timedelta(days=1)), "bank_account_id": 13,
             "credit_account_id": 1013},
            {**ver(132, result="StepUp", created_date=DAY + timedelta(hours=9)),
             "bank_account_id": 13, "credit_account_id": 1013},
        ],
        transaction=[
            {"id": i, "bank_account_verification_id": 1, "amount": Decimal(i), "status": f"S{i}",
             "created_date": DAY + timedelta(minutes=5 - i)} for i in (1, 2, 3, 4)
        ] + [{"id": 9, "bank_account_verification_id": 2, "amount": Decimal(1), "created_date": DAY}],
        lock=[{"id": 5, "bank_account_verification_id": 1}],
        target=[target(4), target(5), target(8), target(9), target(12), target(14)],
    )

    def update(n, origin=None, old=None, **values):
        old = {"is_primary": 1} if old is None else old
        return {"seq": n, "op": "U", "new": account(n, **values), "old": account(n, **{**values, **old}), "origin": origin}

    events = [
        *[{"seq": n, "op": "I", "new": account(n)} for n in (1, 2, 3, 13)],
        update(4, origin="MODERN"),
        update(5),
        update(6),
        update(7, origin="MODERN"),
        {"seq": 8, "op": "D", "old": account(8)},
        {"seq": 9, "op": "D", "old": account(9)},
        {"seq": 10, "op": "D", "old": account(10, account_type_id=2, is_primary=1)},
        {"seq": 11, "op": "D", "old": account(11), "origin": "MODERN"},
        update(12, old={"created_date": DAY}),
        update(14, old={"is_primary": None}),
    ]
    ev = feed(spark, "customer_account", events)
    return merged(L.apply_customer_accounts(ev, t, now(), mask=False), t)


def reasons(log, n, name="customer_account"):
    return [r["failure_reason"] for r in log if r["event_id"] == f"{name}-{n}"]


def test_insert_unless_migrated(customer):
    out, log = customer
    row = out[(1, "ACCOUNT1")]
    assert (row["result"], row["verification_type"]) == ("PENDING_ACH_VALIDATION", "MICRODEPOSIT")
    # Ordered by creation, the fourth transaction is left out.
    assert [row[f"mdamount{i}"] for i in (1, 2, 3)] == [Decimal(4), Decimal(3), Decimal(2)]
    assert row["md1_status"] == "S4" and row["locked"] == "Y" and row["verification_attempts"] == 0
    assert (row["updated_timestamp"], row["change_timestamp"]) == (LOCAL, CHANGED)
    assert (row["created_by"], row["created_timestamp"], row["account_id"]) == ("A", DAY, 1)
    assert reasons(log, 1) == ["Inside Insert and operation"]
    for n in (2, 3):
        assert (n, f"ACCOUNT{n}") not in out and reasons(log, n) == []


def test_newest_verification_of_the_day(customer):
    assert customer[0][(13, "ACCOUNT13")]["verification_type"] == "YODLEE"


def test_update_of_legacy_account_ignores_origin(customer):
    out, log = customer
    row = out[(4, "ACCOUNT4")]
    assert (row["account_type"], row["is_primary"], row["result"]) == ("CHK", 0, "OLD")
    assert reasons(log, 4) == ["Inside Update and operation v_is_migrated != 2"]


def test_update_of_migrated_account(customer):
    out, log = customer
    row = out[(5, "ACCOUNT5")]
    assert (row["result"], row["created_by"], row["credit_account_id"]) == ("PENDING_ACH_VALIDATION", "X", None)
    assert reasons(log, 5) == [
        "Inside Update and operation v_is_migrated = 2 | ABA: R1 | Account: ACCOUNT5"
        " | Credit Card No: 1005 | is_primary_new: 0 | is_primary_old: 1"
        " | account type new: CHK | account type old: CHKFlag:False"
    ]
    assert (7, "ACCOUNT7") not in out and reasons(log, 7)[0].endswith("Flag:True")


def test_update_without_verification_inserts_a_keyless_row(customer):
    row = customer[0][(None, "ACCOUNT6")]
    assert (row["routing_number"], row["result"], row["is_primary"]) == ("R1", None, 0)


def test_deletes(customer):
    out, log = customer
    assert out[(8, "ACCOUNT8")]["result"] == "INACTIVE" and reasons(log, 8) == []
    row = out[(9, "ACCOUNT9")]
    assert (row["result"], row["updated_by"], row["account_type"]) == ("INACTIVE", "A", "SAV")
    tomb = out[(10, "ACCOUNT10")]
    assert (tomb["result"], tomb["verification_type"], tomb["account_type"]) == ("INACTIVE", "MicroDeposit", "SAV")
    assert (tomb["locked"], tomb["mdamount1"], tomb["is_primary"]) == (None, None, 1)
    assert " | ABA:  | Account:  | Credit Card No:  | " in reasons(log, 10)[0]
    assert (11, "ACCOUNT11") not in out and reasons(log, 11) == []


def test_other_updates_do_nothing(customer):
    out, log = customer
    for n in (12, 14):
        assert out[(n, f"ACCOUNT{n}")]["account_type"] == "SAV" and reasons(log, n) == []


# ------------------------------------------------------------------------------- verifications


@pytest.fixture(scope="module")
def verification(spark):
    ids = list(range(1, 12))
    news = {
        1: ver(1, verified_date=DAY), 2: ver(2), 3: ver(3, verification_type="Ews", result="Pass"),
        4: ver(4, is_migrated=2), 5: ver(5, is_migrated=2), 6: ver(6, is_migrated=2),
        7: ver(7, is_migrated=2), 8: ver(8, is_migrated=2), 9: ver(9, is_migrated=None),
    }
    t = world(
        spark, ids,
        lock=[{"id": n, "bank_account_verification_id": n} for n in (1, 4, 5, 6)],
        attempt=[{"id": 100 * n + i, "verification_locking_id": n} for n, k in ((1, 2), (4, 2), (5, 3), (6, 4)) for i in range(k)],
        customer_account=[account(4, is_primary=1), account(7), {**account(70, account_type_id=2), "customer_id": 7, "account_number": "ACCOUNT7"}],
        target=[target(1), target(2), target(3)],
    )
    events = [
        {"seq": n, "op": "U", "new": v, "old": {**v, "verified_date": None, "result": "WAS"},
         "cols": ["verified_date"], "origin": "MODERN" if n == 8 else None}
        for n, v in news.items()
    ]
    events.append({"seq": 99, "op": "U", "new": ver(4, result="Pass"), "old": ver(4), "cols": ["result"]})
    ev = feed(spark, "verification", events)
    return merged(L.apply_verifications(ev, t, now()), t)


def test_refresh_of_legacy_deposits(verification):
    out, log = verification
    one, two = out[(1, "ACCOUNT1")], out[(2, "ACCOUNT2")]
    assert (one["result"], one["verification_type"], one["verification_attempts"]) == ("ACTIVE", "MICRODEPOSIT", 2)
    assert (one["locked"], two["locked"]) == ("Y", "N")
    assert (two["result"], two["verification_attempts"]) == ("WAS", None)
    assert one["updated_timestamp"] == one["change_timestamp"] == NOON
    assert reasons(log, 1, "verification") == []


def test_other_legacy_verifications_are_only_traced(verification):
    out, log = verification
    assert out[(3, "ACCOUNT3")]["result"] == "OLD"
    assert len(reasons(log, 3, "verification")) == 1
    assert (9, "ACCOUNT9") not in out and len(reasons(log, 9, "verification")) == 1


def test_lock_needs_exactly_three_attempts(verification):
    out, _ = verification
    got = {n: (out[(n, f"ACCOUNT{n}")]["locked"], out[(n, f"ACCOUNT{n}")]["verification_attempts"]) for n in (4, 5, 6)}
    assert got == {4: ("N", 2), 5: ("Y", 3), 6: ("N", 4)}
    assert out[(4, "ACCOUNT4")]["is_primary"] == 1 and out[(5, "ACCOUNT5")]["is_primary"] is None
    assert out[(4, "ACCOUNT4")]["result"] == "PENDING_ACH_VALIDATION"


def test_two_customer_accounts_are_rejected(verification):
    out, log = verification
    assert (7, "ACCOUNT7") not in out
    assert reasons(log, 7, "verification") == [L.AMBIGUOUS_ACCOUNT]


def test_echo_is_traced_but_not_merged(verification):
    out, log = verification
    assert (8, "ACCOUNT8") not in out and len(reasons(log, 8, "verification")) == 1
    # Masked by default.
    assert " | Account: UNT8 " in reasons(log, 8, "verification")[0]


# ------------------------------------------------------------------------------------ attempts


@pytest.fixture(scope="module")
def attempt(spark):
    ids = list(range(1, 12))
    t = world(
        spark, ids,
        lock=[{"id": n, "bank_account_verification_id": n} for n in range(1, 9)],
        attempt=[{"id": 1000 + 10 * n + i, "verification_locking_id": n} for n in (2, 3, 4) for i in range(n - 1)],
        verification=[ver(n) for n in (1, 2, 3, 4)] + [ver(n, is_migrated=2) for n in (5, 6, 7, 8)],
        target=[target(n) for n in (1, 2, 3, 4)],
    )

    def tried(seq, lock, channel="Web", origin=None):
        return {"seq": seq, "op": "I", "origin": origin,
                "new": {"id": seq, "verification_locking_id": lock, "channel": channel}}

    events = [tried(n, n) for n in (1, 2, 3, 4)] + [
        tried(5, 5, "CASH"), tried(6, 6, None), tried(70, 7), tried(71, 7), tried(72, 7),
        tried(8, 8, origin="MODERN"), tried(9, 999),
    ]
    return merged(L.apply_attempts(feed(spark, "attempt", events), t, now()), t)


def test_prior_attempts_decide_the_lock(attempt):
    out, _ = attempt
    got = {n: (out[(n, f"ACCOUNT{n}")]["locked"], out[(n, f"ACCOUNT{n}")]["verification_attempts"]) for n in (1, 2, 3, 4)}
    assert got == {1: ("N", 1), 2: ("N", 2), 3: ("Y", 3), 4: ("N", 4)}
    assert out[(1, "ACCOUNT1")]["result"] == "OLD"


def test_migrated_attempts(attempt):
    out, log = attempt
    assert (5, "ACCOUNT5") not in out and (6, "ACCOUNT6") not in out and (8, "ACCOUNT8") not in out
    assert out[(7, "ACCOUNT7")]["verification_attempts"] == 3 and out[(7, "ACCOUNT7")]["locked"] == "Y"
    for n in (5, 6, 70, 8, 9):
        assert len(reasons(log, n, "attempt")) == 1
    assert reasons(log, 5, "attempt") == ["Routing numberR1"]


def test_attempt_without_verification_inserts_a_keyless_row(attempt):
    assert attempt[0][(None, None)]["verification_attempts"] == 1


# -------------------------------------------------------------------------------- transactions


def test_debit_status(spark):
    t = world(spark, range(1, 8), verification=[ver(n) for n in (1, 2, 3, 4)] + [ver(5, is_migrated=2)],
              target=[target(n, md1_status="P") for n in range(1, 6)])

    def txn(n, kind="Debit", old="Received", new="Returned"):
        row = {"id": n, "bank_account_verification_id": n, "accounting_transaction_type": kind}
        return {"seq": n, "op": "U", "new": {**row, "status": new}, "old": {**row, "status": old}, "cols": ["status"]}

    events = [txn(1), txn(2, kind="Credit"), txn(3, new="Received"), txn(4, old=None), txn(5)]
    out, _ = merged(L.apply_transaction_status(feed(spark, "transaction", events), t, now()), t)
    got = {k[0]: (r["md1_status"], r["md2_status"], r["md3_status"]) for k, r in out.items()}
    assert got[1] == ("Returned",) * 3
    assert all(got[n] == ("P", None, None) for n in (2, 3, 4, 5))
