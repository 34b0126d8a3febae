"""Registered queries against their SQL on the same whole tables."""

import pytest

import __spark_entry__ as entry_points
from cadastre.plans.registered import QUERIES, SQL
from tools.check_oracle import compare, connect

# Rows-only queries that are quick enough to run here; fitting the large
# ensembles is covered with small parameters in test_learning.py.
ROWS_ONLY = ("random_split", "ml_linear", "batch_score")


@pytest.fixture(scope="module")
def engine(sf_dir):
    pytest.importorskip("duckdb")
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, engine, name):
    frame = QUERIES[name](spark, sf_dir)
    assert compare(frame, engine, SQL[name]) == []
    # no cross join, no nested loop and no Python worker in any relational query
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [o for o in ("CartesianProduct", "NestedLoop", "Python", "Pandas") if o in plan]


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
    spark.catalog.clearCache()


def test_entry_points(spark):
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert entry_points.entry(spark).columns == ["ciudad", "total", "n_train", "n_test"]
