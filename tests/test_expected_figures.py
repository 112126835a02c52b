"""Figures worked out beforehand for the test tables, by scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

ROOT = "/root/testdata"
SCALES = ["sf0.001", "sf0.01"]


def tally(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


@pytest.fixture(params=range(len(SCALES)), ids=SCALES)
def scale(request):
    return request.param


@pytest.fixture
def run(spark, scale):
    return lambda name: entry.queries()[name](spark, f"{ROOT}/{SCALES[scale]}")


def test_risk_scores(run, scale):
    expected = [{"high": 3, "low": 42, None: 91}, {"high": 24, "medium": 10, "low": 418, None: 911}]
    view = run("customer_360")
    assert tally(view, "risk_score") == expected[scale]
    assert view.filter("total_fraud_count = 2").count() == [0, 10][scale]


def test_alert_levels(run, scale):
    expected = [
        {"high": 6, "medium": 4, "low": 5},
        {"critical": 9, "high": 47, "medium": 44, "low": 50},
    ]
    assert tally(run("fraud_alerts"), "alert_level") == expected[scale]


def test_amount_bands(run, scale):
    expected = [
        {"small": 64, "medium": 404, "large": 490, "very_large": 23},
        {"small": 646, "medium": 4120, "large": 4695, "very_large": 336},
    ]
    bands = run("amount_category_counts").groupBy("amount_category").agg(F.sum("n")).collect()
    assert {r[0]: r[1] for r in bands} == expected[scale]


def test_velocity(run, scale):
    figures = run("velocity_24h").agg(
        F.max("tx_count_24h"), F.count_if("velocity_alert"), F.count_if(F.col("transaction_date").isNull())
    )
    assert tuple(figures.first()) == [(9, 67, 1), (11, 681, 19)][scale]


def test_privacy(run, scale):
    assert run("mask_email").filter("email IS NULL").count() == [5, 55][scale]
    assert run("gdpr_anonymize").filter("full_name = 'ANONYMIZED'").count() == [8, 77][scale]


def test_orphans(run, scale):
    assert run("orphan_counts").filter("child = 'accounts'").first().orphans == [16, 150][scale]


def test_rule_counts(run, scale):
    if scale == 0:
        pytest.skip("figures are those of sf0.01")
    lines = {(r.table_name, r.rule): (r.failed, r.total) for r in run("expectation_report").collect()}
    expected = {
        ("bronze_customers", "email not null"): (30, 1500),
        ("bronze_accounts", "customer_id not null"): (37, 1500),
        ("bronze_transactions", "transaction_id not null"): (33, 10000),
        ("bronze_transactions", "amount positive"): (72, 10000),
        ("silver_customers", "valid kyc_status"): (137, 1500),
        ("silver_accounts", "positive balance"): (122, 1500),
        ("silver_accounts", "valid currency"): (75, 1500),
        ("silver_transactions", "positive amount"): (71, 9967),
        ("silver_transactions", "valid currency"): (99, 9967),
    }
    assert expected.items() <= lines.items()


def test_duplicate_feed(run, scale):
    if scale == 0:
        pytest.skip("figures are those of sf0.01")
    first = run("dedup_first")
    assert (first.count(), first.filter("amount > 0").count()) == (10000, 9887)
