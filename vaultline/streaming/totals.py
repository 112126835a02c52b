"""Account totals that are kept up to date: only the weeks of an account that a batch touches are worked out anew.

A stream over the silver transactions adds each batch, counted by account and second, to a folder of its own,
in folders of a slot (a week, see ``operators.velocity``). Then the account-slots that the batch touched, and
the ones after them, which look back a day, are worked out from the stored seconds of these accounts in these slots
and the ones before, and take the place of their old rows. The totals of an account are the sums over its slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vaultline.functions.derive import cents_and_others, epoch_second, money_total
from vaultline.operators.velocity import SLOT_SECONDS, counted, handed_on, is_alert
from vaultline.session import scratch_dir
from vaultline.sinks.files import exists, remove, replace_partitions, settle
from vaultline.streaming.batches import BATCH, BEFORE_ALL

SLOT = "slot"
NO_DATE = -1  # slot of transactions without a date; all others are multiples of a week

SECONDS = (
    "account_id string, second long, ids long, rows long, frauds long, last_date timestamp, cents decimal(38,2), "
    f"others double, amounts long, {SLOT} long, {BATCH} int"
)
TOTALS = (
    "account_id string, ids long, frauds long, alerts long, last_date timestamp, cents decimal(38,2), others double, "
    f"amounts long, {SLOT} long"
)


def _summed(*more: Column) -> list[Column]:
    """The additive figures of a group of partial sums."""
    sums = [F.sum(c).alias(c) for c in ("ids", "frauds", "amounts", "others")]
    return [*sums, F.sum("cents").cast("decimal(38,2)").alias("cents"), F.max("last_date").alias("last_date"), *more]


def slot_of(second: Column) -> Column:
    return F.coalesce(second - F.pmod(second, F.lit(SLOT_SECONDS)), F.lit(NO_DATE))


def by_second(transactions: DataFrame) -> DataFrame:
    """Partial sums per account and second, with the slot of the second."""
    cents, others = cents_and_others("amount")
    counted = transactions.groupBy("account_id", epoch_second("transaction_date").alias("second")).agg(
        F.count("transaction_id").alias("ids"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_flagged_fraud").alias("frauds"),
        F.max("transaction_date").alias("last_date"),
        cents.cast("decimal(38,2)").alias("cents"),
        others.alias("others"),
        F.count("amount").alias("amounts"),
    )
    return counted.withColumn(SLOT, slot_of(F.col("second")))


def by_slot(stored: DataFrame) -> DataFrame:
    """Totals per account and slot, of seconds of which each account may have a row from every batch.

    Rows are dealt out once, by account and slot after the last day was handed on, and are added up, counted and
    summed where they are.
    """
    rows = handed_on(stored.drop(SLOT)).repartition("account_id", "slot")
    seconds = rows.groupBy("account_id", "slot", "own", "second").agg(*_summed(F.sum("rows").alias("rows")))
    alerts = F.sum(F.when(is_alert(), F.col("rows")).otherwise(0)).alias("alerts")
    totals = counted(seconds.withColumn("in_slot", F.col("slot"))).groupBy("account_id", "in_slot").agg(*_summed(alerts))
    return totals.withColumn(SLOT, F.coalesce("in_slot", F.lit(NO_DATE))).drop("in_slot")


def _same(one: DataFrame, two: DataFrame) -> Column:
    return one["account_id"].eqNullSafe(two["touched_account"]) & (one[SLOT] == two["touched_slot"])


def start_totals(spark: SparkSession, root: str) -> None:
    if not exists(spark, f"{root}/seconds"):
        empty = spark.createDataFrame([], SECONDS).drop(SLOT, BATCH)
        empty.write.mode("overwrite").parquet(f"{root}/seconds/{BATCH}={BEFORE_ALL}/{SLOT}={NO_DATE}")


def add_batch(transactions: DataFrame, number: int, root: str) -> None:
    """Takes in the transactions of a batch; one that is run again has the same effect as once."""
    spark = transactions.sparkSession
    settle(spark, f"{root}/totals")
    folder = f"{root}/seconds/{BATCH}={number}"
    added = by_second(transactions).hint("rebalance", F.col(SLOT))
    added.write.mode("overwrite").partitionBy(SLOT).parquet(folder)
    mine = spark.read.schema(SECONDS.rpartition(",")[0]).parquet(folder)
    slots = [row[SLOT] for row in mine.select(SLOT).distinct().collect()]  # weeks, not rows
    if not slots:
        return
    after = {s + SLOT_SECONDS for s in slots if s != NO_DATE}
    before = {s - SLOT_SECONDS for s in {*slots, *after} if s != NO_DATE}
    touches = F.array(F.col(SLOT), F.when(F.col(SLOT) != NO_DATE, F.col(SLOT) + SLOT_SECONDS))
    touched = mine.select(F.col("account_id").alias("touched_account"), F.explode(touches).alias("touched_slot"))
    touched = touched.where("touched_slot is not null").distinct()

    stored = spark.read.schema(SECONDS).parquet(f"{root}/seconds")
    stored = stored.where(F.col(SLOT).isin([*{*slots, *after, *before}]) & (F.col(BATCH) <= number))
    # Written first, so that Spark knows their size and need not shuffle the stored seconds to meet few accounts.
    listed = scratch_dir(spark, "touched")
    mine.select(F.col("account_id").alias("touched_account")).distinct().write.parquet(listed)
    accounts = spark.read.schema("touched_account string").parquet(listed)
    of_touched = stored.join(accounts, stored["account_id"].eqNullSafe(accounts["touched_account"]), "left_semi")
    slotted = by_slot(of_touched)
    new = slotted.join(touched, _same(slotted, touched), "left_semi")
    if exists(spark, f"{root}/totals"):
        old = spark.read.schema(TOTALS).parquet(f"{root}/totals").where(F.col(SLOT).isin([*{*slots, *after}]))
        new = new.unionByName(old.join(touched, _same(old, touched), "left_anti"))
    replace_partitions(new.hint("rebalance", F.col(SLOT)), f"{root}/totals", SLOT)
    remove(spark, listed)


def keep_totals(transactions: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """A stream that keeps the totals at ``root`` up to date with a stream of the silver transactions."""
    start_totals(transactions.sparkSession, root)

    def store(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, root)

    return transactions.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def read_totals(spark: SparkSession, root: str) -> DataFrame:
    """One row for each account, with the sums of its slots."""
    settle(spark, f"{root}/totals")
    stored = spark.read.schema(TOTALS).parquet(f"{root}/totals") if exists(spark, f"{root}/totals") else None
    rows = stored if stored is not None else spark.createDataFrame([], TOTALS)
    return rows.groupBy("account_id").agg(*_summed(F.sum("alerts").alias("alerts")))


def stored_fraud_by_account(spark: SparkSession, root: str) -> DataFrame:
    """As ``operators.velocity.fraud_by_account`` of all transactions taken in."""
    return read_totals(spark, root).select(
        "account_id",
        F.col("frauds").alias("total_fraud_txns"),
        F.col("alerts").alias("velocity_alerts_count"),
        F.col("last_date").alias("last_fraud_date"),
    )


def stored_tx_metrics(spark: SparkSession, root: str) -> DataFrame:
    """As ``operators.rollups.tx_metrics`` of all transactions taken in."""
    spent = money_total(F.col("cents"), F.col("others"))
    return read_totals(spark, root).select(
        "account_id",
        F.col("ids").alias("total_transactions"),
        spent.alias("total_amount_spent"),
        F.try_divide(spent, F.col("amounts")).alias("avg_transaction_amount"),
        F.col("last_date").alias("last_transaction_date"),
        F.col("frauds").alias("fraud_count"),
    )
