"""Guarded writes against a loop, and modern verifications among legacy images in any cut."""

import random
from datetime import timedelta

import pytest
from helpers import DAY, feed, rows, tables
from pyspark.sql import functions as F
from test_batch_cuts import in_parts, state
from test_legacy_flows import ver
from test_modern_accounts import LATER, PROVE, stored, update

from duosync.operators.lookup import enrich_as_of
from duosync.operators.merge import compare_and_set

VER = "bank_account_verification_id"


@pytest.mark.parametrize("seed", range(5))
def test_guarded_writes_are_the_loop(spark, seed):
    rng = random.Random(seed)
    cells = {k: (rng.choice([None, 0]), -1) for k in "abc"}
    plain, guarded, want = [(k, -1, v) for k, (v, _) in cells.items()], [], set()
    for seq in range(120):
        key, value = rng.choice("abc"), rng.choice([None, seq, seq])
        if rng.random() < 0.2:
            plain.append((key, seq, value))
            cells[key] = (value, seq)
            continue
        guarded.append((key, seq, value))
        now_there, written = cells[key]
        if now_there is None:
            want.add(seq)
            cells[key] = (value, written)
    ev = spark.createDataFrame(guarded, "k string, seq long, new long")
    history = spark.createDataFrame(plain, "k string, seq long, old long").withColumn("written", F.col("seq"))
    seen = enrich_as_of(ev, history, ["k"], "seq", ["old", "written"])
    got = compare_and_set(seen, ["k", "written"], "seq", F.col("old"), F.col("new"), width=7)
    assert {r.seq for r in got.collect()} == want


def test_nothing_to_write(spark):
    ev = spark.createDataFrame([], "k string, w long, seq long, old long, new long")
    assert compare_and_set(ev, ["k", "w"], "seq", F.col("old"), F.col("new")).collect() == []


EARLY = DAY - timedelta(days=3)
# By customer: legacy images (seq, date, result), numbers of modern verifications, the date and audits they leave.
CASES = {
    # A legacy date after the modern verification: that one takes effect, then the image wins.
    2: ([(92, EARLY, "Pass")], [52], EARLY, 1),
    # A legacy date before it: the guard holds.
    3: ([(33, EARLY, "Pass")], [53], EARLY, 0),
    # Two verifications: the second finds a date.
    4: ([], [54, 64], LATER, 1),
    # A legacy image takes the date back between them, so both take effect.
    5: ([(75, None, "StepUp")], [55, 95], LATER, 2),
}


def migrated(n, **more):
    return ver(n, is_migrated=2, work_case_id=500 + n, **more)


def world(spark):
    bank = {"aba_number": "R1", "account_type": "Savings"}
    return tables(
        spark,
        credit_account=[{"credit_account_id": n + 1000, "customer_id": n} for n in CASES],
        bank_account=[{"id": n, "account_number": f"ACCOUNT{n}", **bank} for n in CASES],
        customer_account=[stored(n, 2) for n in CASES],
        verification=[migrated(n) for n in CASES],
    )


def image(n, seq, date, result):
    new = migrated(n, verified_date=date, result=result)
    return {"seq": seq, "op": "U", "old": migrated(n), "new": new, "cols": ["verified_date", "result"]}


def test_legacy_dates_around_modern_verifications(spark):
    feeds = {
        "verification": feed(spark, "verification", [image(n, *i) for n, c in CASES.items() for i in c[0]]),
        "modern_account": feed(spark, "modern_account", [
            update(n, PROVE, seq=s) for n, c in CASES.items() for s in c[1]
        ]),
    }
    once = in_parts(spark, feeds, world(spark), [])
    dates = {r[VER]: r["verified_date"] for r in rows(once[0]["verification"])}
    assert dates == {n: c[2] for n, c in CASES.items()}
    closed = [line for line in once[1]["audit"] if "RCLOSED" in line]
    assert len(closed) == sum(c[3] for c in CASES.values())
    several = in_parts(spark, feeds, world(spark), [60])
    assert state(several[0]) == state(once[0])
    assert several[1] == once[1]
