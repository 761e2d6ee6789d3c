"""Rows that are valid at an event, against a loop over all of them."""

import random

import pytest
from pyspark.sql import functions as F

from duosync.operators.lookup import during, valid_ranges


@pytest.mark.parametrize("low", [0, 10**15])
def test_during_is_the_loop(spark, low):
    rng = random.Random(low)
    versions = []
    for row in range(60):
        for at in sorted(rng.sample(range(-1, 400), rng.randint(1, 6))):
            key = rng.choice(["a", "b", "b", "c", None])
            versions.append((row, low + at if at >= 0 else -1, key, rng.randint(0, 9), rng.random() < 0.8))
    events = [(rng.choice(["a", "b", "c", "d", None]), low + rng.randrange(400), i) for i in range(150)]
    df = spark.createDataFrame(versions, "row long, seq long, key string, value int, there boolean")
    ranges = valid_ranges(df, "row").filter("there").withColumn("_n", F.lit(1).cast("long"))
    ev = spark.createDataFrame(events, "key string, seq long, event int")
    order = [F.col("value"), F.col("row")]
    got = during(ev, ranges, ["key"], "seq", order, ["row", "value"]).collect()
    assert len(got) == len(events)
    for r in got:
        last = {}
        for row, at, key, value, there in versions:
            if at < r.seq:
                last[row] = (key, value, there)
        alive = [(v, row) for row, (k, v, there) in last.items() if there and k == r.key and k is not None]
        best = max(alive, default=(None, None))
        assert (r.n_found, r.value, r.row) == (len(alive), *best)


def test_during_without_events_or_ranges(spark):
    ranges = spark.createDataFrame([], "key string, _from long, _to long, _n long, v int")
    ev = spark.createDataFrame([("a", 5)], "key string, seq long")
    (row,) = during(ev, ranges, ["key"], "seq", [F.col("v")], ["v"]).collect()
    assert (row.n_found, row.v) == (0, None)
    assert during(ev.limit(0), ranges, ["key"], "seq", [F.col("v")], ["v"]).collect() == []


def test_a_hot_key_makes_no_pairs(spark):
    """Twenty thousand events and rows of one key: each event asks one block of each size."""
    n = 20_000
    ranges = spark.range(n).selectExpr("'a' AS key", "id AS _from", "id + 50 AS _to", "1L AS _n", "id AS v")
    ev = spark.range(n).selectExpr("'a' AS key", "id AS seq")
    got = during(ev, ranges, ["key"], "seq", [F.col("v")], ["v"])
    sums = got.agg(F.sum("n_found"), F.sum("v"), F.count("*")).first()
    want = [min(s, 50) for s in range(n)]
    assert tuple(sums) == (sum(want), sum(s - 1 for s in range(1, n)), n)
