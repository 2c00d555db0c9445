"""Every query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as contract
from ordermill.plans import catalog, oracles, upkeep, upkeep_sql
from ordermill.plans.inspect import plan_text
from tests.compare import connect, rows_of, types_of

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES | upkeep.QUERIES
ORACLES = oracles.ORACLES | upkeep_sql.ORACLES


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def check_plan(result):
    """No join without keys, and nothing leaves the JVM."""
    text = plan_text(result)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert node not in text


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_and_types(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    check_plan(result)
    assert dict(result.dtypes) == types_of(db, ORACLES[name])
    expected = db.execute(ORACLES[name]).fetchdf()
    assert rows_of(result.toPandas()) == rows_of(expected)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).columns == ["window_date", "state", "most_bought_size"]
