import datetime as dt

import pytest
from conftest import plan_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vaultline.operators import dedup, rules
from vaultline.operators.rules import Rule
from vaultline.plans import bronze, silver
from vaultline.schemas import RAW, SILVER_ACCOUNTS, SILVER_CUSTOMERS, SILVER_TRANSACTIONS

RULES = (Rule("known", "k IS NOT NULL"), Rule("positive", "v > 0", drop=True), Rule("small", "v < 9", drop=True))
ROWS = [("a", 1.0), (None, 2.0), ("b", None), ("c", -1.0), ("d", 9.0), (None, 0.0)]


def test_only_drop_rules_drop_and_unknown_counts_as_broken(spark):
    df = spark.createDataFrame(ROWS, "k string, v double")
    watched = Observation("watched")
    kept = rules.enforce(df, RULES, watched).collect()
    assert sorted((r.k or "", r.v) for r in kept) == [("", 2.0), ("a", 1.0)]
    assert watched.get == {"rows": 6, "known": 2, "positive": 3, "small": 2}


def test_report_counts_each_rule_on_all_rows(spark):
    df = spark.createDataFrame(ROWS, "k string, v double")
    lines = {r.rule: (r.table_name, r.action, r.total, r.failed) for r in rules.report(df, RULES, "t").collect()}
    assert lines == {
        "known": ("t", "warn", 6, 2),
        "positive": ("t", "drop", 6, 3),
        "small": ("t", "drop", 6, 2),
    }


def test_report_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert [(r.total, r.failed) for r in rules.report(df, RULES, "t").collect()] == [(0, 0)] * 3


def test_rules_without_metrics_reach_the_scan(spark, scratch):
    spark.createDataFrame(ROWS, "k string, v double").write.parquet(scratch)
    plan = plan_of(rules.enforce(spark.read.parquet(scratch), RULES))
    assert "GreaterThan(v,0.0)" in plan


def test_first_arrival_wins_and_null_is_a_key(spark):
    rows = [
        ("a", 2, "late"), ("a", 1, "early"), (None, 5, "late"), (None, 4, "early"),
        ("b", None, "unknown"), ("b", 0, "x"),
    ]
    df = spark.createDataFrame(rows, "k string, at int, v string").repartition(3)
    first = {r.k: r.v for r in dedup.first_per_key(df, ["k"], ["at"]).collect()}
    assert first == {"a": "early", None: "early", "b": "unknown"}


def test_ties_are_settled_the_same_way_in_every_layout(spark):
    df = spark.range(400).select(
        (F.col("id") % 7).alias("k"), F.lit(1).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    picks = {
        tuple(sorted((r.k, r.v) for r in dedup.first_per_key(layout, ["k"], ["at"]).collect()))
        for layout in (df.coalesce(1), df.repartition(9), df.orderBy(F.desc("id")))
    }
    assert len(picks) == 1


def test_copies_of_a_key_are_cut_down_before_the_shuffle(spark):
    hot = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string"))
    first = dedup.first_per_key(spark.range(1000).select(hot.alias("k"), "id"), ["k"], ["id"])
    plan = plan_of(first)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert first.count() == 335


SEEN = {"_ingested_at": dt.datetime(2024, 1, 1), "_source_file": "f"}


def raw_transaction(**fields):
    base = {name: None for name in RAW["transactions"].names}
    base |= {"transaction_id": "t", "account_id": "a", "amount": 5.0, "currency": "EUR"}
    return base | SEEN | fields


def raw_frame(spark, entity, rows):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW[entity].fields)
    return spark.createDataFrame(rows, f"{schema}, _ingested_at timestamp, _source_file string")


def test_a_bad_first_copy_keeps_a_good_later_copy_out(spark):
    later = dt.datetime(2024, 1, 2)
    rows = [
        raw_transaction(transaction_id="x", amount=-1.0),
        raw_transaction(transaction_id="x", amount=7.0, _ingested_at=later),
        raw_transaction(transaction_id="y", amount=7.0),
        raw_transaction(transaction_id="y", amount=-1.0, _ingested_at=later),
    ]
    kept = silver.transactions(raw_frame(spark, "transactions", rows)).collect()
    assert [(r.transaction_id, r.amount) for r in kept] == [("y", 7.0)]


def test_silver_transactions_round_then_judge(spark):
    amounts = {"zero": 0.004, "cent": 0.006, "edge": 99.996, "none": None, "dollar": 5.0}
    rows = [
        raw_transaction(transaction_id=k, amount=v, currency="USD" if k == "dollar" else "EUR")
        for k, v in amounts.items()
    ]
    table = silver.transactions(raw_frame(spark, "transactions", rows))
    assert tuple(table.columns) == SILVER_TRANSACTIONS
    assert sorted((r.transaction_id, r.amount, r.amount_category) for r in table.collect()) == [
        ("cent", 0.01, "small"),
        ("edge", 100.0, "medium"),
    ]


def test_silver_accounts_and_customers(spark):
    common = {"customer_id": "c", "account_type": "savings", "currency": "EUR", "status": "active", **SEEN}
    accounts = raw_frame(
        spark,
        "accounts",
        [
            {"account_id": "a", "balance": 20000.004, "opened_at": "2024-01-01T00:00:00", **common},
            {"account_id": "b", "balance": -0.004, "opened_at": "never", **common},
            {"account_id": "n", "balance": -0.006, "opened_at": None, **common},
        ],
    )
    table = silver.accounts(accounts)
    assert tuple(table.columns) == SILVER_ACCOUNTS
    found = sorted((r.account_id, r.balance, r.is_high_balance, r.opened_at is None) for r in table.collect())
    assert found == [
        ("a", 20000.0, False, False),
        ("b", 0.0, False, True),
    ]
    person = {"full_name": " jo ", "email": " J@X ", "phone": "1", "is_deleted": False, "created_at": "2024"}
    statuses = {"1": "verified", "2": "unknown", "3": None}
    customers = raw_frame(
        spark,
        "customers",
        [{"customer_id": k, "kyc_status": status, **person, **SEEN} for k, status in statuses.items()],
    )
    table = silver.customers(customers)
    assert tuple(table.columns) == SILVER_CUSTOMERS
    assert [(r.customer_id, r.full_name, r.email) for r in table.collect()] == [("1", "JO", "j@x")]


def test_bronze_drops_only_transactions_without_ids(spark):
    rows = [
        raw_transaction(),
        raw_transaction(transaction_id=None),
        raw_transaction(account_id=None),
        raw_transaction(amount=-1.0),
    ]
    assert bronze.raw("transactions", raw_frame(spark, "transactions", rows)).count() == 2


def test_strict_parsing_fails_on_malformed_dates(spark):
    rows = [raw_transaction(transaction_date="not-a-date")]
    frame = raw_frame(spark, "transactions", rows)
    assert silver.transactions(frame).first().transaction_date is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        silver.transactions(frame, strict=True).collect()
