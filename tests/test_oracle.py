"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry
import oracle
from lotwise.plans import driver_queries, driver_sql, lake_queries, lake_sql

QUERIES = {**driver_queries.QUERIES, **lake_queries.QUERIES}
SQL = {**driver_sql.SQL, **lake_sql.SQL}

# The queries that need the HTML table function; all others stay out of Python.
TOKENIZED = {
    "page_cards", "page_fields", "page_listings", "page_listings_b", "page_sold", "page_changes",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    with oracle.connect(sf_dir) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_gives_what_its_sql_gives(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert oracle.differences(df, con, SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    for node in ("BatchEvalPython ", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"):
        assert node not in plan
    assert ("BatchEvalPythonUDTF" in plan) == (name in TOKENIZED)


@pytest.mark.parametrize(
    "name", ["region_nation_stats", "fold_small_groups", "province_lookup", "lookup_last_wins", "combine_and_fold"]
)
def test_joins_hold_beyond_the_broadcast_size(spark, con, sf_dir, name):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        df = QUERIES[name](spark, sf_dir)
        assert oracle.differences(df, con, SQL[name]) == []
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
