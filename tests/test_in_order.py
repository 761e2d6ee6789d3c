"""Accounts with many type changes: every event against a one-by-one model, in a fixed number of jobs."""

import random

import pytest
from helpers import feed, tables
from pyspark.sql import functions as F
from test_modern_accounts import add, image, new_id, update

from duosync.plans import modern_side as M
from duosync.plans.lineage import Scratch

IDS = {"CHK": M.CHECKING, "SAV": M.SAVINGS}


def model(events, stored):
    """What each event does, one by one, on lists of (id, primary) per type."""
    have = {t: [(r[0], r[2]) for r in stored if r[1] == t] for t in IDS.values()}
    several = {t: len(have[t]) > 1 for t in IDS.values()}
    out = {}

    def count(t):
        return 2 if several[t] else min(len(have[t]), 1)

    def put(t, row):
        several[t] = several[t] or bool(have[t])
        have[t] = [row]

    for e in events:
        new, old = e["new"], e.get("old")
        kind, to = new["operation_type"], IDS[new["account_type"]]
        of = IDS[old["account_type"]] if old else M.SAVINGS
        row = min(have[of]) if have[of] else (None, None)
        did = None
        if e["op"] == "I":
            if not count(of) and new["result"] == "ACTIVE":
                did = "opens"
                put(to, (new_id(e["seq"], "account"), 0))
        elif kind == "DELETE":
            did = ("misses", "removes", "ambiguous")[count(of)]
            if did == "removes":
                have[of] = []
        elif count(of):
            flips = old["is_primary"] == 0 and new["is_primary"] == 1 and row[1] in (0,)
            stopped = flips and not count(to)
            if flips and count(to) > 1:
                did = "ambiguous"
            elif of != to and not stopped:
                did = "retypes" if count(of) == 1 else "ambiguous"
                if did == "retypes":
                    have[of] = []
                    put(to, row)
        out[e["seq"]] = (did, row[0])
    return out


def account_events(n, rng, first, how_many):
    events, seq = [], first
    for _ in range(how_many):
        of, to = rng.choice(["CHK", "SAV"]), rng.choice(["CHK", "SAV"])
        roll = rng.random()
        if roll < 0.25:
            e = add(n, seq=seq, account_type=to, result=rng.choice(["ACTIVE", "NEW"]))
        elif roll < 0.4:
            e = update(n, {}, seq=seq, operation_type="DELETE", account_type=of)
        else:
            flip = {"is_primary": 0} if rng.random() < 0.2 else {}
            e = update(n, {"account_type": of, **flip}, seq=seq, account_type=to, **({"is_primary": 1} if flip else {}))
        events.append(e)
        seq += rng.choice([1, 2])
    return events


def decided(spark, events, stored, width=None):
    ev = feed(spark, "modern_account", events).withColumns(
        {"customer_id": F.col("after.legacy_customer_id"), "routing_number": F.col("after.routing_number"),
         "account_number": F.col("after.account_number"), "unverified": F.lit(False)}
    ).withColumns(M._gates())
    accounts = tables(spark, customer_account=stored)["customer_account"]
    scratch = Scratch(spark)
    out = M.decide_in_order(ev, M.account_entries(accounts, None), width=width, cut=scratch)
    kinds = ["opens", "retypes", "removes", "misses", "ambiguous"]
    did = F.coalesce(*[F.when(F.col(k), k) for k in ["ambiguous", *kinds]])
    got = {r.seq: (r.did, r.found_id) for r in out.select("seq", did.alias("did"), "found_id").collect()}
    scratch.release()
    return got


@pytest.mark.parametrize("seed,width", [(1, 2), (2, 3), (3, None)])
def test_random_events_of_some_accounts(spark, seed, width):
    rng = random.Random(seed)
    events, stored, want = [], [], {}
    for n in range(1, 13):
        mine = [(1000 * n + k, t, rng.choice([0, 1, None]))
                for k, t in enumerate(rng.choice([[], [1], [2], [1, 2], [1, 1], [2, 2]]))]
        some = account_events(n, rng, 1000 * n, rng.choice([5, 12, 40]))
        events += some
        want |= model(some, mine)
        place = image(n)
        stored += [
            {"customer_bank_account_id": i, "customer_id": n, "routing_number": place["routing_number"],
             "account_number": place["account_number"], "account_type_id": t, "is_primary": p}
            for i, t, p in mine
        ]
    got = decided(spark, events, stored, width)
    assert {"opens", "retypes", "removes", "misses", "ambiguous"} <= {d for d, _ in got.values()}
    assert {s: (d, i) for s, (d, i) in got.items()} == want


def jobs(spark, work, name):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_a_thousand_type_changes_take_as_many_jobs_as_twenty(spark):
    def swaps(k):
        sides = ["SAV", "CHK"]
        return [
            add(1, seq=1),
            *[update(1, {"account_type": sides[i % 2]}, seq=2 + i, account_type=sides[1 - i % 2]) for i in range(k)],
        ]

    # Chunks of eight events: the few fill three, the many 126 in 16 groups.
    few, a = jobs(spark, lambda: decided(spark, swaps(20), [], 8), "few")
    many, b = jobs(spark, lambda: decided(spark, swaps(1000), [], 8), "many")
    assert [many[2 + i] for i in range(1000)] == [("retypes", new_id(1, "account"))] * 1000
    assert few == {seq: many[seq] for seq in few}
    assert b == a
