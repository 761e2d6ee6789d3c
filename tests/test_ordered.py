"""Running values against brute force, with a key that holds a third of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from duosync.operators.deposits import prior_attempts
from duosync.operators.generate import dense_ids
from duosync.plans.lineage import Scratch
from duosync.operators.lookup import enrich_as_of
from duosync.operators.ordered import running


def skewed(n, seed):
    rnd = random.Random(seed)
    keys = ["hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None]) for _ in range(n)]
    seqs = rnd.sample(range(-50, 4 * n), n)
    return [(k, s, rnd.choice([None, rnd.randint(0, 99)])) for k, s in zip(keys, seqs, strict=True)]


@pytest.mark.parametrize("width", [1, 7, 64, 10_000])
def test_running(spark, width):
    data = skewed(400, width)
    df = spark.createDataFrame(data, "k string, seq long, v int")
    out = running(
        df, ["k"], "seq",
        {"n": ("count", F.col("v").isNotNull()), "prev": ("last", F.col("v")), "top": ("max", F.col("v"))},
        width=width,
    )
    got = {r.seq: (r.n, r.prev, r.top) for r in out.collect()}
    assert out.columns == ["k", "seq", "v", "n", "prev", "top"]
    for k, s, _ in data:
        before = sorted((q, v) for j, q, v in data if j == k and q < s and v is not None and k)
        vals = [v for _, v in before]
        want = (len(vals), vals[-1] if vals else None, max(vals) if vals else None)
        assert got[s] == want, (k, s)


def test_hot_key_is_spread(spark):
    """No window sorts a whole key: the row-level one is partitioned by chunk as well."""
    df = spark.range(1000).select((F.col("id") % 1).alias("k"), F.col("id").alias("seq"))
    out = running(df, ["k"], "seq", {"n": ("count", None)}, width=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan
    assert out.filter("n <> seq").count() == 0


@pytest.mark.parametrize("inclusive", [True, False])
def test_as_of(spark, inclusive):
    rnd = random.Random(5)
    hist = [(rnd.choice("ab"), s, s * 10) for s in rnd.sample(range(200), 60)]
    ev = [(i, rnd.choice("abz"), rnd.randint(-5, 220)) for i in range(200)]
    out = enrich_as_of(
        spark.createDataFrame(ev, "id int, k string, seq long"),
        spark.createDataFrame(hist, "k string, seq long, v long"),
        ["k"], "seq", ["v"], inclusive=inclusive, width=16,
    )
    got = {r.id: r.v for r in out.collect()}
    assert len(got) == 200
    for i, k, s in ev:
        older = [(q, v) for j, q, v in hist if j == k and (q <= s if inclusive else q < s)]
        assert got[i] == (max(older)[1] if older else None)


def test_prior_attempts_add_committed(spark):
    ev = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "lock long, seq long")
    stored = spark.createDataFrame([(1,), (1,), (3,)], "lock long")
    got = {r.seq: r.prior for r in prior_attempts(ev, ["lock"], "seq", stored).collect()}
    assert got == {10: 2, 11: 3, 12: 0}


def test_dense_ids(spark):
    rows = spark.range(500).selectExpr("(id * 7) % 500 AS x").repartition(9)
    out = dense_ids(rows, ["x"], "n", Scratch(spark), start=7)
    assert sorted((r.x, r.n) for r in out.collect()) == [(x, x + 8) for x in range(500)]
    # The next batch goes on; an empty one gives nothing.
    more = dense_ids(spark.range(3).withColumnRenamed("id", "x"), ["x"], "n", Scratch(spark), start=507)
    assert sorted(r.n for r in more.collect()) == [508, 509, 510]
    assert dense_ids(rows.limit(0), ["x"], "n", Scratch(spark)).collect() == []
