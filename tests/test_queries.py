"""Every registered query against its SQL, on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from duosync.catalog import flow_queries
from duosync.catalog.compare import connect, difference
from duosync.catalog.flow_queries import FLOWS
from duosync.catalog.operator_queries import QUERIES as OPERATORS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
QUERIES = {name: q for name, q in entry.queries().items() if name in {**OPERATORS, **FLOWS}}


@pytest.fixture(scope="module", autouse=True)
def shared_flows():
    """Queries over one flow's outputs share its result, which is written once."""
    with pytest.MonkeyPatch.context() as patch:
        for name in ("_accounts", "_deposits"):
            patch.setattr(flow_queries, name, once(getattr(flow_queries, name)))
        yield


def once(run):
    made = {}

    def shared(d):
        if d.sf_dir not in made:
            made[d.sf_dir] = run(d)
        return made[d.sf_dir]

    return shared


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
