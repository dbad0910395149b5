"""Every registered query gives the rows of its SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module
from snaptrack.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
#: Queries without a row on so small a table.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    rows, problems = compare(
        spark, con, QUERIES[name], ORACLES[name], SF
    )
    assert not problems
    assert rows or name in MAY_BE_EMPTY


def test_entry_runs(spark):
    outcome = {r.outcome: r.works for r in entry_module.entry(spark).collect()}
    assert outcome["Obra Nueva"] > 0 and outcome["up"] > 0
