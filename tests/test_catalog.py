"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
import check_queries
from courtledger import catalog

SF = "/root/testdata/sf0.001"
READ_PAGES = {"html_tables", "page_tables", "box_score", "game_tables", "team_stats", "hidden_cells", "injury_pages", "picks_pages"}


@pytest.fixture(scope="module")
def db():
    return check_queries.connect(SF)


def test_contract(spark):
    assert set(catalog.all_sql()) == set(catalog.all_queries())
    assert set(catalog.all_queries()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query(spark, db, name):
    df = catalog.all_queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert ("Python" in plan or "MapInArrow" in plan) == (name in READ_PAGES)
    assert check_queries.compare(df, db, catalog.all_sql()[name]) is None
