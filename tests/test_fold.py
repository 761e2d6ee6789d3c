"""Folding a batch equals applying its events one by one, however the batch is split."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from duosync.operators.merge import (
    PatchShape,
    apply_patches,
    merge_delete,
    merge_upsert,
    one_primary,
    valid_promotions,
    with_bookkeeping,
)

SHAPE = PatchShape(
    keys=("k",),
    columns=("a", "b", "c"),
    sets=(("a",), ("a", "b"), ("a", "b", "c")),
    types=("int", "int", "int"),
)
KINDS = [(("a",), None), (("a", "b"), None), (("a", "b"), ("a", "c")), (("a", "b", "c"), ("a", "b", "c"))]
DDL = "k string, seq long, event_id string, a int, b int, c int, update_mask long, insert_mask long"


def bits(cols):
    return None if cols is None else sum(1 << SHAPE.columns.index(c) for c in cols)


def one_by_one(rows, events):
    """rows: key → values; keyless inserts are kept in a list."""
    rows, loose = {k: dict(v) for k, v in rows.items()}, []
    for key, _, kind, vals in sorted(events, key=lambda e: e[1]):
        update, insert = KINDS[kind]
        new = {c: vals[c] if insert and c in insert else None for c in "abc"}
        if key is not None and key in rows:
            rows[key].update({c: vals[c] for c in update})
        elif insert is None:
            continue
        elif key is None:
            loose.append(new)
        else:
            rows[key] = new
    return rows, loose


def patches(spark, events):
    data = [
        (k, s, f"e{s}", v["a"], v["b"], v["c"], bits(KINDS[kind][0]), bits(KINDS[kind][1]))
        for k, s, kind, v in events
    ]
    return spark.createDataFrame(data, DDL)


def state(df):
    out = [((r.k), (r.a, r.b, r.c)) for r in df.collect()]
    keyed = {k: v for k, v in out if k is not None}
    assert len(keyed) == sum(k is not None for k, _ in out)
    return keyed, sorted((v for k, v in out if k is None), key=str)


value = st.one_of(st.none(), st.integers(0, 9))
event = st.tuples(
    st.sampled_from(["x", "y", "z", None]),
    st.integers(0, 3),
    st.fixed_dictionaries({"a": value, "b": value, "c": value}),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=st.lists(event, max_size=25), cut=st.integers(0, 25))
def test_fold_equals_one_by_one(spark, events, cut):
    events = [(k, seq, kind, v) for seq, (k, kind, v) in enumerate(events)]
    start = {"x": {"a": 1, "b": 2, "c": 3}}
    want, loose = one_by_one(start, events)
    tgt = with_bookkeeping(spark.createDataFrame([("x", 1, 2, 3)], "k string, a int, b int, c int"), SHAPE)
    for part in (events[:cut], events[cut:]):
        tgt = apply_patches(tgt, patches(spark, part), SHAPE)
    got, got_loose = state(tgt)
    assert got == {k: (v["a"], v["b"], v["c"]) for k, v in want.items()}
    assert got_loose == sorted(((v["a"], v["b"], v["c"]) for v in loose), key=str)


def test_replay_and_late_patches_change_nothing(spark):
    rnd = random.Random(3)
    events = [
        (rnd.choice(["x", "y", None]), s, rnd.randrange(4), {c: rnd.randint(0, 9) for c in "abc"})
        for s in range(30)
    ]
    tgt = spark.createDataFrame([("x", 1, 2, 3)], "k string, a int, b int, c int")
    once = apply_patches(tgt, patches(spark, events), SHAPE)
    again = apply_patches(once, patches(spark, events), SHAPE)
    late = apply_patches(once, patches(spark, [e for e in events[:10] if e[0]]), SHAPE)
    assert state(once) == state(again) == state(late)


def test_strict_keys_leave_keyless_rows_out(spark):
    p = patches(spark, [(None, 1, 2, {"a": 1, "b": 1, "c": 1})])
    tgt = spark.createDataFrame([], "k string, a int, b int, c int")
    assert apply_patches(tgt, p, SHAPE).count() == 1
    assert apply_patches(tgt, p, SHAPE, strict_keys=True).count() == 0


def test_upsert_with_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a", "p"), (None, "b", "q")], "id int, v string, w string")
    src = spark.createDataFrame([(1, "A", "P"), (None, "B", "Q"), (2, "C", "R")], "id int, v string, w string")
    got = merge_upsert(tgt, src, ["id"], ["v"], ["v", "w"]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(
        map(str, [(1, "A", "p"), (None, "b", "q"), (None, "B", "Q"), (2, "C", "R")])
    )


def test_soft_delete(spark):
    tgt = spark.createDataFrame([(1, "ACTIVE", 5, 6)], "id int, result string, at int, x int")
    src = spark.createDataFrame([(1, 9, 9), (2, 9, 9)], "id int, at int, x int")
    both = merge_delete(tgt, src, ["id"], ["at"], ["at", "x"])
    assert sorted(map(tuple, both.collect())) == [(1, "INACTIVE", 9, 6), (2, "INACTIVE", 9, 9)]
    only = merge_delete(tgt, src, ["id"], ["at"], None)
    assert [tuple(r) for r in only.collect()] == [(1, "INACTIVE", 9, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_one_primary_equals_one_by_one(spark, seed):
    rnd = random.Random(seed)
    flags = {("c1", 1): 1, ("c1", 2): 0, ("c2", 3): 0}
    alive, born = dict(flags), {k: -1 for k in flags}
    lifetimes = [(c, a, -1, True) for c, a in flags]
    promotions, next_id = [], 4
    for seq in range(40):
        what, c = rnd.choice(["new", "drop", "promote", "promote"]), rnd.choice(["c1", "c2"])
        mine = [k for k in alive if k[0] == c]
        if what == "new":
            alive[(c, next_id)], born[(c, next_id)] = 0, seq
            lifetimes.append((c, next_id, seq, True))
            next_id += 1
        elif what == "drop" and mine:
            k = rnd.choice(mine)
            del alive[k]
            lifetimes.append((*k, seq, False))
        elif what == "promote":
            k = (c, rnd.randrange(1, next_id))
            promotions.append((*k, seq))
            if k in alive:
                for other in mine:
                    alive[other] = int(other == k)
    ddl = "customer_id string, account_id int, seq long"
    live = [(c, a, born[(c, a)], flags.get((c, a), 0)) for c, a in alive]
    valid = valid_promotions(
        spark.createDataFrame(promotions, ddl),
        spark.createDataFrame(lifetimes, ddl + ", alive boolean"),
        width=4,
    )
    got = one_primary(
        spark.createDataFrame(live, "customer_id string, account_id int, born_seq long, is_primary int"),
        valid,
    )
    assert {(r.customer_id, r.account_id): r.is_primary for r in got.collect()} == alive
