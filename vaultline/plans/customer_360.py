"""Gold: one row per customer with account and transaction totals and a risk score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.derive import risk_score
from vaultline.operators.rollups import account_metrics, tx_metrics
from vaultline.schemas import CUSTOMER_360, UPDATED_AT

CLUSTER_COLUMNS = ("risk_score", "customer_id")  # the id alone is unique, it would leave the score unordered


def scored(accounts: DataFrame, metrics: DataFrame) -> DataFrame:
    """Totals and score per customer id; customers without accounts are not here, so not scored."""
    needed = accounts.select("account_id", "customer_id", "balance")
    return account_metrics(needed, metrics).withColumn("risk_score", risk_score())


def scored_accounts(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    return scored(accounts, tx_metrics(transactions))


def customer_360(customers: DataFrame, accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """``customers`` may be the silver table or the change-capture table."""
    return view_of(customers, accounts, tx_metrics(transactions))


def view_of(customers: DataFrame, accounts: DataFrame, metrics: DataFrame) -> DataFrame:
    """From metrics per account, such as those that ``streaming.totals`` keeps."""
    return (
        customers.join(scored(accounts, metrics), "customer_id", "left")
        .withColumn(UPDATED_AT, F.current_timestamp())
        .select(*CUSTOMER_360)
    )
