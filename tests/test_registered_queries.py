import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, rows  # noqa: E402
from conftest import plan_of  # noqa: E402
from vaultline.workload import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 15


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, sf_dir, name):
    frame = entry.queries()[name](spark, sf_dir)
    result = duck.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(result.columns)
    assert rows(frame.columns, frame.collect()) == rows(result.columns, result.fetchall())


# Row counts worked out beforehand for the smallest test tables.
EXPECTED_ROWS = {
    "bronze_customers": 150, "bronze_accounts": 150, "bronze_transactions": 996, "silver_customers": 136,
    "silver_accounts": 133, "silver_transactions": 981, "tx_metrics": 15, "fraud_alerts": 15,
    "account_metrics": 51, "customer_360": 136, "cdc_scd1": 12, "rls_customers_fr": 35, "rls_customers_be": 47,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_expected_row_counts(spark, sf_dir, name):
    if not sf_dir.rstrip("/").endswith("sf0.001"):
        pytest.skip("counts are those of sf0.001")
    assert entry.queries()[name](spark, sf_dir).count() == EXPECTED_ROWS[name]


# These run streams or write tables while they are built, so they are left to the tests above.
EAGER = ("stream", "refresh", "sink", "json", "infer", "source_file", "table_tags", "cdc_stream", "gdpr_stored", "rule_counts", "rls_membership")


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if not n.startswith(EAGER)))
def test_plans_stay_in_the_jvm_and_never_pair_all_rows(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    for operator in ("CartesianProduct", "NestedLoopJoin", "CollectLimit", "SinglePartition, REPARTITION"):
        assert operator not in plan
    # The corpus operators are free to use Python; their own tests say which are not.
    assert name not in QUERIES or "Python" not in plan
