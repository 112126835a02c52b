import datetime as dt
import re

from conftest import plan_of
from pyspark.sql import functions as F

from vaultline.operators import rollups
from vaultline.plans import customer_360, fraud_alerts
from vaultline.schemas import CUSTOMER_360, FRAUD_ALERTS
from vaultline.workload.adapter import Bank

CUSTOMERS = "customer_id string, full_name string, email string, kyc_status string, is_deleted boolean"
ACCOUNTS = "account_id string, customer_id string, balance double"
MOVES = (
    "transaction_id string, account_id string, amount double, transaction_date timestamp_ntz, "
    "is_flagged_fraud boolean, status string"
)
JAN = [dt.datetime(2024, 1, day) for day in range(1, 32)]


def move(n, account, amount, day=0, fraud=False, status="completed"):
    return (str(n), account, amount, JAN[day], fraud, status)


def tables(spark):
    customers = [(c, c.upper(), f"{c}@x", "verified", False) for c in ("two", "one", "three", "idle", "bare")]
    accounts = [
        ("a1", "two", 10.5), ("a2", "two", 0.25), ("b1", "one", 1.0), ("c1", "three", 1.0),
        ("d1", "idle", 7.0), ("x1", None, 3.0),
    ]
    moves = [
        move(1, "a1", 10.0, 0, True), move(2, "a1", 20.0, 3, True, "failed"), move(3, "a2", 100.0, 9, None),
        move(4, "b1", 5.0, 1, True), move(5, "b1", 5.0, 9),
        *[move(10 + i, "c1", 1.1, i, True) for i in range(4)],
        move(20, "x1", 1.0), move(21, "dropped", 1.0, 4, True), move(22, "dropped", 1.0, 5, True),
    ]
    return (
        spark.createDataFrame(customers, CUSTOMERS),
        spark.createDataFrame(accounts, ACCOUNTS),
        spark.createDataFrame(moves, MOVES),
    )


def test_tx_metrics_take_every_status(spark):
    _, _, moves = tables(spark)
    row = rollups.tx_metrics(moves).filter("account_id = 'a1'").first()
    assert tuple(row) == ("a1", 2, 30.0, 15.0, JAN[3], 2)


def test_tx_metrics_without_any_amount(spark):
    moves = spark.createDataFrame([("1", "a", None, None, None, "x")], MOVES)
    assert tuple(rollups.tx_metrics(moves).first()) == ("a", 1, None, None, None, 0)


def test_customer_360(spark):
    customers, accounts, moves = tables(spark)
    view = customer_360.customer_360(customers, accounts, moves)
    assert tuple(view.columns) == CUSTOMER_360
    rows = {r.customer_id: r for r in view.collect()}
    assert len(rows) == 5
    two = rows["two"]
    # the plain mean of the account means 15 and 100; a fraud count of two scores low
    assert (two.total_accounts, two.total_balance, two.total_transactions) == (2, 10.75, 3)
    assert (two.total_amount_spent, two.avg_transaction_amount) == (130.0, 57.5)
    assert (two.total_fraud_count, two.risk_score, two.last_transaction_date) == (2, "low", JAN[9])
    assert (rows["one"].total_fraud_count, rows["one"].risk_score) == (1, "medium")
    assert (rows["three"].total_fraud_count, rows["three"].risk_score) == (4, "high")
    assert rows["three"].total_amount_spent == 4.4
    # an account without transactions: totals unknown, score low
    idle = rows["idle"]
    assert (idle.total_accounts, idle.total_transactions, idle.total_fraud_count) == (1, None, None)
    assert (idle.total_amount_spent, idle.avg_transaction_amount, idle.risk_score) == (None, None, "low")
    # no account at all: not even a score
    assert (rows["bare"].total_accounts, rows["bare"].risk_score) == (None, None)
    assert all(r._updated_at is not None for r in rows.values())


def test_fraud_alerts(spark):
    customers, accounts, moves = tables(spark)
    alerts = fraud_alerts.fraud_alerts(moves, accounts, customers)
    assert tuple(alerts.columns) == FRAUD_ALERTS
    rows = {r.account_id: r for r in alerts.collect()}
    # every account with transactions, also harmless ones and ones without a stored account
    assert set(rows) == {"a1", "a2", "b1", "c1", "x1", "dropped"}
    assert (rows["c1"].alert_level, rows["c1"].requires_investigation) == ("critical", True)
    assert (rows["a1"].alert_level, rows["a1"].full_name) == ("high", "TWO")
    assert (rows["b1"].alert_level, rows["b1"].requires_investigation) == ("low", False)
    # the last date of any transaction
    assert (rows["b1"].total_fraud_txns, rows["b1"].last_fraud_date) == (1, JAN[9])
    assert (rows["dropped"].customer_id, rows["dropped"].alert_level) == (None, "high")
    assert (rows["x1"].customer_id, rows["x1"].full_name, rows["x1"].kyc_status) == (None, None, None)
    assert all(r._updated_at is not None for r in rows.values())


def test_velocity_alone_makes_a_medium_alert(spark):
    customers, accounts, _ = tables(spark)
    burst = [move(i, "a1", 1.0) for i in range(6)]
    steady = [move(100 + i, "b1", 1.0, i) for i in range(9)]
    alerts = fraud_alerts.fraud_alerts(spark.createDataFrame(burst + steady, MOVES), accounts, customers)
    levels = {r.account_id: (r.velocity_alerts_count, r.alert_level) for r in alerts.collect()}
    assert levels == {"a1": (6, "medium"), "b1": (0, "low")}


def stored(spark, sf_dir, root):
    read = {}
    for entity, df in Bank(spark, sf_dir).all_silver().items():
        df.write.parquet(f"{root}/{entity}")
        read[entity] = spark.read.parquet(f"{root}/{entity}")
    return read


def scanned(plan):
    """Columns read, by the key column that identifies the table."""
    return [set(re.findall(r"(\w+)#", cols)) for cols in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]


def test_gold_plans_shuffle_twice_per_key_and_read_only_what_they_use(spark, sf_dir, scratch, static_plans):
    silver = stored(spark, sf_dir, scratch)
    plan = plan_of(customer_360.customer_360(**silver))
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) == ["account_id", "account_id", "customer_id", "customer_id"]
    assert {"transaction_id", "account_id", "amount", "transaction_date", "is_flagged_fraud"} in scanned(plan)
    assert {"account_id", "customer_id", "balance"} in scanned(plan)

    plan = plan_of(fraud_alerts.fraud_alerts(**silver))
    assert {"transaction_id", "account_id", "transaction_date", "is_flagged_fraud"} in scanned(plan)
    assert {"account_id", "customer_id"} in scanned(plan)
    assert {"customer_id", "full_name", "kyc_status"} in scanned(plan)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filter_on_the_customer_reaches_both_sides(spark, sf_dir, scratch, static_plans):
    silver = stored(spark, sf_dir, scratch)
    plan = plan_of(customer_360.customer_360(**silver).filter("customer_id = '7'"))
    assert plan.count("EqualTo(customer_id,7)") == 2


def test_ownerless_accounts_do_not_share_one_task(spark):
    n = 5000
    by_account = spark.range(n).select(F.concat(F.lit("a"), "id").alias("account_id"))
    accounts = spark.createDataFrame([("a0", "c0")], "account_id string, customer_id string")
    people = "customer_id string, full_name string, kyc_status string"
    customers = spark.createDataFrame([("c0", "Jo", "verified")], people)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = fraud_alerts.fraud_enriched(by_account, accounts, customers)
        sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n and max(sizes) < n / 2
        assert [r.account_id for r in rows.filter("full_name = 'Jo'").collect()] == ["a0"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_adaptive_execution_splits_a_customer_with_very_many_accounts(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    n = 20_000
    numbered = spark.range(0, n, 1, 8).withColumn("account_id", F.concat(F.lit("a"), "id"))
    by_account = numbered.select("account_id", F.col("id").alias("total_fraud_txns"))
    owner = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), "id"))
    accounts = numbered.select("account_id", owner.alias("customer_id"))
    customers = accounts.select("customer_id").distinct()
    customers = customers.withColumns({"full_name": F.lit("Jo"), "kyc_status": F.lit("x")})
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = fraud_alerts.fraud_enriched(by_account, accounts, customers)
        assert len([r for r in rows.collect() if r.full_name == "Jo"]) == n
        assert "SortMergeJoin(skew=true)" in plan_of(rows)
    finally:
        for key in settings:
            spark.conf.unset(key)
