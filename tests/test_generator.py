"""The properties generated records must have."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultline.operators import quality as q
from vaultline.plans import checkbook
from vaultline.schemas import RAW
from vaultline.sources import generator

PEOPLE, MOVES = 100, generator.DEFAULT_TRANSACTIONS


@pytest.fixture(scope="module")
def generated(spark):
    people = generator.row_numbers(spark, PEOPLE)
    return {
        "customers": generator.customers(people),
        "accounts": generator.accounts(people),
        "transactions": generator.transactions(generator.row_numbers(spark, MOVES), PEOPLE),
    }


@pytest.mark.parametrize("entity", ["customers", "accounts", "transactions"])
def test_layout_is_that_of_the_landing_files(generated, entity):
    found = [(f.name, f.dataType) for f in generated[entity].schema.fields]
    assert found == [(f.name, f.dataType) for f in RAW[entity].fields]


@pytest.mark.parametrize("entity", ["customers", "accounts", "transactions"])
def test_all_quality_checks_pass(generated, entity):
    checks = {
        "customers": lambda: checkbook.customers(q.row_count(PEOPLE)),
        "accounts": lambda: checkbook.accounts(q.row_count_at_least(PEOPLE)),
        "transactions": lambda: checkbook.transactions(q.row_count(MOVES)),
    }[entity]()
    report = q.report(generated[entity], checks).collect()
    assert len(report) == len(checks)
    assert [r.check_name for r in report if not r.passed] == []


def test_foreign_keys_hit_and_spread(generated):
    accounts, moves = generated["accounts"], generated["transactions"]
    assert tuple(q.orphans(moves, "account_id", accounts).first()) == (MOVES, 0)
    assert tuple(q.orphans(accounts, "customer_id", generated["customers"]).first()) == (PEOPLE, 0)
    assert moves.select("account_id").distinct().count() == PEOPLE


def test_shares_and_ranges(generated):
    active = generated["accounts"].agg(F.avg((F.col("status") == "active").cast("int"))).first()[0]
    assert 0.45 < active < 0.75
    moves = generated["transactions"]
    done = moves.agg(F.avg((F.col("status") == "completed").cast("int"))).first()[0]
    assert 0.45 < done < 0.55
    bounds = moves.groupBy("is_flagged_fraud").agg(F.min("amount").alias("low"), F.max("amount").alias("high"))
    ranges = {r.is_flagged_fraud: (r.low, r.high) for r in bounds.collect()}
    assert ranges[True][0] >= 500 and ranges[True][1] <= 9999
    assert ranges[False][0] >= 1 and ranges[False][1] <= 3000
    assert moves.filter("round(amount, 2) != amount").count() == 0


def test_dates_lie_within_the_bounds(spark):
    start, end = dt.datetime(2023, 5, 1), dt.datetime(2023, 5, 2)
    dates = generator.customers(generator.row_numbers(spark, 500), start, end).agg(
        F.min("created_at"), F.max("created_at")
    ).first()
    assert start.isoformat() <= dates[0] < dates[1] <= end.isoformat()


def test_reruns_and_other_layouts_give_the_same_rows(spark):
    rows = generator.row_numbers(spark, 200)
    bounds = (dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1))
    once = generator.transactions(rows, 10, *bounds)
    again = generator.transactions(rows.repartition(7), 10, *bounds)
    assert once.exceptAll(again).count() == 0 == again.exceptAll(once).count()
