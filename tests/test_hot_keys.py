"""Lookups where one key, or none, has most of the events."""

import pytest
from pyspark.sql import functions as F

from duosync.operators.lookup import enrich, latest, lookup_one

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    "spark.sql.shuffle.partitions": "16",
}
LOOKUPS = {
    "enrich": lambda ev, dim: enrich(ev, dim, ["k"], [F.col("v")]),
    "latest": lambda ev, dim: latest(ev, dim, ["k"], [F.col("v")]),
    "lookup_one": lambda ev, dim: lookup_one(ev, dim, ["k"]).drop("n_found"),
}
ROWS = 200_000


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    # Half of the events have the key 7, a quarter has none; the looked-up keys are whole numbers of another type.
    key = "CASE WHEN id % 2 = 0 THEN 7 WHEN id % 4 = 1 THEN NULL ELSE id % 5000 END"
    ev = spark.range(0, ROWS, 1, 16).selectExpr("id AS seq", f"CAST({key} AS int) AS k")
    yield ev, spark.range(0, 4000, 1, 4).selectExpr("id AS k", "id * 10 AS v")
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", sorted(LOOKUPS))
def test_hot_and_absent_keys_are_spread(skewed, name):
    ev, dim = skewed
    out = LOOKUPS[name](ev, dim).withColumn("part", F.spark_partition_id())
    got = out.collect()
    assert len(got) == ROWS
    for r in got:
        assert r.v == (r.k * 10 if r.k is not None and r.k < 4000 else None)
    sizes = {}
    for r in got:
        sizes[r.part] = sizes.get(r.part, 0) + 1
    ordered = sorted(sizes.values())
    assert ordered[-1] <= 3 * ordered[len(ordered) // 2], ordered
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
