"""The operators' queries against their SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from duosync.catalog.compare import connect, difference
from duosync.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = connect(SF_DIR)
    for name in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_dedup", "decontamination", "packing"
    ]
