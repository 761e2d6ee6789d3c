"""Stand-in transactions and the flows that read them, over order keys beyond the range of their ids."""

from datetime import datetime

import pytest

from duosync.catalog import flow_queries as Q
from duosync.catalog import standins as S
from duosync.operators.generate import MOST_SEQ

DAY = datetime(2024, 6, 1)
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,\
 l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"


def data(spark, folder, shift, orders=30):
    """Thirty orders with four lines each; ``shift`` moves their keys, a multiple of 60 nothing else."""
    lines = [
        (n + shift, p, 7, p, 3.0 + p, 10.0 * p, "RAN"[(n + p) % 3], "FO"[n % 2], DAY)
        for n in range(orders)
        for p in (4, 3, 2, 1)
    ]
    spark.createDataFrame(lines, LINE).write.parquet(f"{folder}/lineitem.parquet")
    rows = [
        (n + shift, n % 6, "FOP"[n % 3], 5.0, DAY, PRIORITIES[n % 5]) for n in range(orders)
    ]
    spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string",
    ).write.parquet(f"{folder}/orders.parquet")
    segments = ["AUTOMOBILE", "BUILDING", "MACHINERY", "HOUSEHOLD", "FURNITURE", "HOUSEHOLD"]
    customers = [(c, f"C{c}", 7, 4000.0, segments[c]) for c in range(6)]
    spark.createDataFrame(
        customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ).write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(
        [], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    ).write.parquet(f"{folder}/events.parquet")
    return S.Data(spark, str(folder))


def by_id(d):
    return [(r.id, r.seq, r.number) for r in d.transactions().orderBy("number", "id").collect()]


def test_small_keys_keep_ids_and_numbers(spark, tmp_path):
    d = data(spark, tmp_path, 0)
    want = [(r.id, r.id * 4 + 3, str(r.id * 4 + 3)) for r in d.sql(S.TXN).collect()]
    assert sorted(by_id(d)) == sorted(want)


@pytest.mark.parametrize("shift", [149_940, 9_000_000, 54_000_000, 6_000_000_000])
def test_large_keys_keep_the_order_within_range(spark, tmp_path, shift):
    """One order is small, so the numbers span everything from it on."""
    d = data(spark, tmp_path, shift)
    small = d.lineitem.limit(1).selectExpr(
        "0L AS l_orderkey", *[c for c in d.lineitem.columns if c != "l_orderkey"]
    ).collect()
    d.lineitem = d.lineitem.unionByName(spark.createDataFrame(small, d.lineitem.schema))
    found = sorted(d.transactions().collect(), key=lambda r: int(r.number))
    assert all(0 <= r.seq <= MOST_SEQ and 0 <= r.id < 1 << 63 for r in found)
    assert [r.seq for r in found] == sorted({r.seq for r in found})
    assert [r.id for r in found] == sorted({r.id for r in found})
    # Small numbers keep their place among those of the other feeds.
    assert found[0].seq == int(found[0].number)
    exact = {
        str((r.l_orderkey * S.UNIT + ((r.l_partkey * 10 + r.l_linenumber) * 10000 + 7) * 100 + int(r.l_quantity)) * 4 + 3)
        for r in d.lineitem.collect()
    }
    assert {r.number for r in found} == exact


@pytest.mark.parametrize(
    ("name", "shift"), [("flow_transaction", 9_000_000), ("flow_verification", 54_000_000), ("run_batch", 149_940)]
)
def test_flows_over_large_keys(spark, tmp_path, name, shift):
    """At 149,940 events left the range of event numbers, at 9,000,000 these the range of a long, at
    54,000,000 the ids, too."""
    want = Q.FLOWS[name](data(spark, tmp_path / "small", 0)).collect()
    got = Q.FLOWS[name](data(spark, tmp_path / "large", shift)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert any(r.md1_status for r in want)
