"""Physical plans: what must not appear at scale, and where rows are dropped early."""

import pytest

import __spark_entry__ as entry
from duosync.catalog.operator_queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# These end in totals over the whole table; dense numbering also joins its few bucket counts.
TOTALS = {"route_branches", "dense_ids"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TOTALS))
def test_no_bottleneck(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert bad not in text, bad


def test_pivot_shuffles_once_and_drops_late_rows_first(spark):
    text = plan(entry.queries()["pivot3"](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == 1
    partial = text.rindex("WindowGroupLimit")
    assert partial > text.index("Exchange hashpartitioning")


def test_one_row_per_key_is_chosen_before_the_shuffle(spark):
    text = plan(entry.queries()["first_match"](spark, SF_DIR))
    assert "partial_min_by" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["semi_accounts"](spark, SF_DIR))
    assert "EqualTo(r_name,ASIA)" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text


def test_legacy_filter_without_lookup_columns_reads_little(spark):
    text = plan(entry.queries()["prior_attempts"](spark, SF_DIR))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text
