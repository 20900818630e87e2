import pytest
from oracle import connect, same

from tidemark.plans import catalogue


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_agrees_with_its_sql(spark, sf, con, name):
    same(catalogue.QUERIES[name](spark, sf), con, catalogue.ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert set(catalogue.QUERIES) <= set(e.queries())
    assert e.entry(spark).count() == 1


def test_bounds_reach_the_scan(spark, sf):
    plan = catalogue.keyed_incremental_next_page(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "TakeOrderedAndProject" in plan
    plan = catalogue.insert_only_resume_page(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan
