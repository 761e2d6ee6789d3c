"""Branch scenarios of the external-account flow: one customer and account per scenario."""

from datetime import timedelta

import pytest
from helpers import DAY, feed, now, rows, tables

from duosync.functions import codes
from duosync.operators.generate import SLOTS
from duosync.plans import modern_side as M

LATER = DAY + timedelta(days=1)


def new_id(seq, slot):
    return -(seq * 32 + SLOTS[slot] + 1)


def image(n, **values):
    base = {
        "stage_sequence_id": n, "modern_bank_account_id": n, "legacy_customer_id": n,
        "credit_account_id": n + 1000, "routing_number": "R1", "account_number": f"ACCOUNT{n}",
        "account_type": "SAV", "single_use": "0", "operation_type": "ADD", "is_primary": 0,
        "channel": "WEB", "created_by": "C", "created_timestamp": DAY, "updated_by": "U",
        "updated_timestamp": LATER, "result": "ACTIVE",
    }
    return {**base, **values}


def add(n, seq=None, **values):
    return {"seq": seq or n, "op": "I", "new": image(n, **values)}


def update(n, old, seq=None, **values):
    values = {"operation_type": "UPDATE", **values}
    return {"seq": seq or n, "op": "U", "new": image(n, **values), "old": image(n, **{**values, **old})}


MOVE = {"result": "PENDING_ACH_VERIFICATION"}
PROVE = {"result": "PENDING_ACH_VALIDATION"}
EVENTS = [
    add(1, result="PENDING_ACH_VERIFICATION"),
    add(2, verification_type="AGENT", verified_date=LATER),
    add(3, verification_type="EWS", is_primary=1),
    add(4, result="NEW"),
    add(5, verification_type="MICRODEPOSIT", channel="OTHER"),
    add(6, single_use="1"),
    add(7, single_use=None),
    add(8),
    add(9, account_type="CHK"),
    update(10, MOVE, result="PENDING_ACH_VALIDATION"),
    update(11, PROVE),
    update(12, PROVE),
    update(13, PROVE),
    update(14, {"is_primary": 0, "account_type": "CHK"}, is_primary=1),
    update(15, {"routing_number": "R0"}),
    update(16, {"account_type": "CHK"}),
    update(17, {}, operation_type="DELETE"),
    update(18, {}, operation_type="DELETE", account_type="CHK"),
    # Several events on one account in one batch.
    add(20, seq=201),
    add(20, seq=202),
    update(20, {}, seq=203, operation_type="DELETE"),
    add(20, seq=204),
    add(21, seq=211, account_type="CHK"),
    update(21, {"account_type": "CHK"}, seq=212),
    update(21, {}, seq=213, operation_type="DELETE"),
    update(22, {"is_primary": 0}, operation_type="PRIMARY_UPDATE", is_primary=1),
    update(23, {"is_primary": 0}, operation_type="PRIMARY_UPDATE", is_primary=1),
    add(24, seq=241, account_type="CHK"),
    add(24, seq=242, account_type="CHK"),
    update(24, {}, seq=243, operation_type="DELETE", account_type="CHK"),
]


def stored(n, type_id, primary=0):
    return {
        "customer_bank_account_id": n, "customer_id": n, "routing_number": "R1",
        "account_number": f"ACCOUNT{n}", "account_type_id": type_id, "is_primary": primary,
        "created_date": DAY,
    }


def deposit(n, **values):
    return {
        "bank_account_verification_id": n, "verification_type": "MicroDeposit",
        "created_date": DAY, "credit_account_id": n + 1000, "is_migrated": 2,
        "bank_account_id": n, "work_case_id": n + 500, **values,
    }


@pytest.fixture(scope="module")
def out(spark):
    known = [8, 11, 12, 13]
    t = tables(
        spark,
        user=[{"id": 1, "individual_identifier": 1, "identifier_type": 2, "individual_name": "Known"},
              {"id": 5, "individual_identifier": 2, "identifier_type": 1}],
        holder=[{"customer_id": 2, "credit_account_id": 1002, "name_id": 7}],
        name=[{"name_id": 7, "name": "Second Customer"}],
        bank_account=[{"id": n, "aba_number": "R1", "account_number": f"ACCOUNT{n}",
                       "account_type": "Savings"} for n in known],
        card=[{"card_id": 33, "credit_account_id": 1003, "current_card": 1},
              {"card_id": 34, "credit_account_id": 1003, "current_card": 0}],
        bank_directory=[{"rt_micr": "R1", "rt_instit": "First Bank"}],
        customer_account=[
            stored(8, 2), stored(9, 1), stored(14, 1), stored(16, 1, 1), stored(17, 2),
            stored(22, 2), stored(23, 2, None),
            {**stored(220, 1, 1), "customer_id": 22},
        ],
        verification=[deposit(11), deposit(12, verified_date=DAY)],
    )
    ev = feed(spark, "modern_account", EVENTS)
    parties = M.resolve_parties(ev, t)
    from duosync.plans.lineage import Scratch

    cut = Scratch(spark)
    res = M.apply_modern_accounts(ev, t, now(), parties=parties, mask=False, cut=cut)
    snapshot = M.account_snapshot(t["customer_account"], res)
    got = {n: rows(df) for n, df in res.items()}
    got["snapshot"] = rows(snapshot)
    got["derived"] = rows(M.derived_account_events(t["customer_account"], snapshot.drop("born_seq"), res))
    cut.release()
    return got


def cases(out, n):
    return sorted(c["type_id"] for c in out["case"] if c["credit_account_id"] == n + 1000)


def audits(out, uc):
    lines = sorted((a for a in out["audit"] if a["uc_id"] == uc), key=lambda a: a["line_no"])
    return [a["data"] for a in lines]


def checks(out, n):
    mine = [v for v in out["verification"] if v["credit_account_id"] == n + 1000]
    return sorted((v["created_date"], v["verification_type"], v["result"]) for v in mine)


def of(out, name, seq):
    return [r for r in out[name] if r.get("event_id") == f"modern_account-{seq}"]


def accounts(out, n):
    return {
        r["customer_bank_account_id"]: (r["account_type_id"], r["is_primary"])
        for r in out["snapshot"]
        if r["customer_id"] == n
    }


MICROS = timedelta(microseconds=11)


def test_step_up_pending(out):
    assert cases(out, 1) == [415472]
    texts = audits(out, new_id(1, "case"))
    assert len(texts) == 5 and texts[3] == "Verification Status:  Failed"
    assert texts[1] == "Verification on account ending in: UNT1"
    assert checks(out, 1) == [(DAY, "Initial", "StepUp"), (DAY + MICROS, "Ews", "StepUp")]
    assert len([m for m in out["id_map"] if m["modern_bank_account_id"] == 1]) == 1
    assert accounts(out, 1) == {}


def test_agent_active(out):
    assert cases(out, 2) == [325470, 415471]
    mine = [c for c in out["case"] if c["credit_account_id"] == 1002]
    assert {c["ref_num"] for c in mine} == {"modern_account-2"}
    assert len(audits(out, new_id(2, "case"))) == 5
    assert audits(out, new_id(2, "registration")) == [
        "USE CASE CREATED, STATUS OPEN",
        "Bank Information Updated, First Bank, R1, ACCOUNT2, SAV",
        "STATUS CHANGED TO RCLOSED",
    ]
    main = [v for v in out["verification"] if v["bank_account_verification_id"] == new_id(2, "verification")]
    assert main[0]["verified_date"] == DAY and main[0]["work_case_id"] == new_id(2, "case")
    assert main[0]["channel"] == "Web" and main[0]["result"] == "Pass"
    assert accounts(out, 2) == {new_id(2, "account"): (2, 0)}
    assert [h["change_code"] for h in of(out, "history", 2)] == [1]


def test_primary_registration(out):
    assert checks(out, 3) == [(DAY + MICROS, "Ews", "Pass")]
    assert cases(out, 3) == [325470]
    assert accounts(out, 3) == {new_id(3, "account"): (2, 1)}
    assert [o["change_type"] for o in of(out, "outbox", 3)] == [3]
    assert [c["card_id"] for c in out["case"] if c["credit_account_id"] == 1003] == [33]


def test_new_and_other_types(out):
    assert checks(out, 4) == [(DAY + MICROS, "Initial", "StepUp")]
    assert cases(out, 4) == []
    assert checks(out, 5) == [(DAY + MICROS, "UnKnown", "Pass")]


@pytest.mark.parametrize("n", [6, 7])
def test_single_use_leaves_user_and_bank_only(out, n):
    assert new_id(n, "user") in {u["id"] for u in out["user"]}
    assert new_id(n, "bank") in {b["id"] for b in out["bank_account"]}
    assert checks(out, n) == [] and cases(out, n) == [] and accounts(out, n) == {}


def test_users(out):
    users = {u["individual_identifier"]: u for u in out["user"]}
    assert 1 not in users
    assert users[2]["individual_name"] == "Second Customer" and users[2]["identifier_type"] == 2
    assert users[3]["individual_name"] is None


def test_insert_looks_for_savings_only(out):
    assert checks(out, 8) == [] and accounts(out, 8) == {8: (2, 0)}
    assert accounts(out, 9) == {9: (1, 0), new_id(9, "account"): (1, 0)}


def test_moved_to_validation(out):
    assert accounts(out, 10) == {new_id(10, "account"): (2, 0)}
    assert cases(out, 10) == [325470]
    assert [c["open_date"] for c in out["case"] if c["credit_account_id"] == 1010] == [LATER]
    assert [h["change_code"] for h in of(out, "history", 10)] == [1]


def test_verified(out):
    patch = {p["bank_account_verification_id"]: p for p in out["verification_patch"]}
    assert set(patch) == {11}
    assert patch[11]["verified_date"] == LATER and patch[11]["result"] == "Pass"
    assert audits(out, 511)[2] == "STATUS CHANGED TO RCLOSED "
    assert audits(out, 512) == []


def test_verification_missing_is_rejected(out):
    assert [(r["kind"], r["failure_reason"]) for r in of(out, "log", 13)] == [
        ("reject", M.NO_VERIFICATION)
    ]


def test_missing_account_stops_later_branches(out):
    assert accounts(out, 14) == {14: (1, 0)}
    assert of(out, "outbox", 14) == [] and cases(out, 14) == []


def test_route_change_is_only_logged(out):
    (log,) = of(out, "log", 15)
    assert (log["kind"], log["status"], log["table_id"]) == ("trace", "INFO", "15")
    assert cases(out, 15) == []


def test_type_change(out):
    assert accounts(out, 16) == {16: (2, 1)}
    assert [o["change_type"] for o in of(out, "outbox", 16)] == [0]
    assert [h["change_code"] for h in of(out, "history", 16)] == [3]
    assert cases(out, 16) == [325470] and len(audits(out, new_id(16, "registration"))) == 3


def test_delete(out):
    assert accounts(out, 17) == {} and cases(out, 17) == [325470]
    assert [h["change_code"] for h in of(out, "history", 17)] == [2]
    (trace,) = of(out, "log", 17)
    assert trace["failure_reason"] == "v_customer_bank_account_id:17"
    assert trace["created_by"] == codes.TRACE_DELETE_CREATED_BY
    (reject,) = of(out, "log", 18)
    assert reject["kind"] == "reject" and of(out, "history", 18) == []


def test_events_see_earlier_ones_of_the_batch(out):
    # Opened, seen as existing, removed, opened again.
    assert accounts(out, 20) == {new_id(204, "account"): (2, 0)}
    assert [len(of(out, "history", s)) for s in (201, 202, 203, 204)] == [1, 0, 1, 1]
    # Opened as checking, turned into savings, removed as savings.
    assert accounts(out, 21) == {}
    assert [len(of(out, "history", s)) for s in (211, 212, 213)] == [1, 1, 1]


def test_primary_switch(out):
    assert accounts(out, 22) == {22: (2, 1), 220: (1, 0)}
    assert [h["change_code"] for h in of(out, "history", 22)] == [3]
    # An unknown flag blocks the switch.
    assert accounts(out, 23) == {23: (2, None)} and of(out, "outbox", 23) == []


def test_two_rows_for_one_account_are_ambiguous(out):
    assert len(accounts(out, 24)) == 2
    (log,) = of(out, "log", 243)
    assert (log["kind"], log["failure_reason"]) == ("reject", M.AMBIGUOUS_ACCOUNT)


def test_derived_events(out):
    by_account = {}
    for e in out["derived"]:
        key = (e["after"] or e["before"])["customer_bank_account_id"]
        by_account[key] = e
    assert {e["origin"] for e in out["derived"]} == {"MODERN"}
    assert by_account[17]["op"] == "D" and by_account[16]["op"] == "U"
    assert by_account[220]["after"]["is_primary"] == 0 and by_account[22]["after"]["is_primary"] == 1
    assert by_account[new_id(2, "account")]["op"] == "I"
    assert 8 not in by_account
