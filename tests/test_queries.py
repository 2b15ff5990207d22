"""Every registered query against its check SQL, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from fleetaudit.plans import catalog
from fleetaudit.plans.adapters import TABLES
from tools.check_queries import compare

SF_DIR = "/root/testdata/sf0.001"
CHECKS = catalog.CHECKS

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not there")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_a_check():
    assert set(catalog.QUERIES) == set(CHECKS) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("NestedLoop", "Cartesian", "Python", "ArrowEval"):
        assert node not in plan
    assert compare(df, CHECKS[name], connection) is None


@pytest.mark.parametrize("name", ("policy_drift", "pattern_matches", "missing_fields", "broken_references", "template_policy", "validate_documents"))
def test_joins_without_broadcast(spark, connection, name):
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for threshold in thresholds:
        spark.conf.set(threshold, "-1")
    try:
        assert compare(entry.queries()[name](spark, SF_DIR), CHECKS[name], connection) is None
    finally:
        for threshold in thresholds:
            spark.conf.unset(threshold)


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["index", "policy"]
