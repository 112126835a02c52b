"""Gold: fraud and velocity indicators of every account that has transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.derive import alert_level, requires_investigation
from vaultline.operators.velocity import fraud_by_account
from vaultline.schemas import FRAUD_ALERTS, UPDATED_AT


def fraud_enriched(by_account: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Account totals with owner; an account that was dropped upstream keeps its row, without one.

    Such accounts can be many and all have the NULL customer. The second join column, a hash of the
    customer or else of the account, keeps them from meeting in one task.
    """
    owned = by_account.join(accounts.select("account_id", "customer_id"), "account_id", "left")
    people = customers.select("customer_id", "full_name", "kyc_status")
    owned = owned.withColumn("_spread", F.xxhash64(F.coalesce("customer_id", "account_id")))
    people = people.withColumn("_spread", F.xxhash64("customer_id"))
    return owned.join(people, ["customer_id", "_spread"], "left").drop("_spread")


def fraud_alerts(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return alerts_of(fraud_by_account(transactions), accounts, customers)


def alerts_of(by_account: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """From totals per account, such as those that ``streaming.totals`` keeps."""
    return (
        fraud_enriched(by_account, accounts, customers)
        .withColumn("alert_level", alert_level())
        .withColumns(
            {"requires_investigation": requires_investigation(), UPDATED_AT: F.current_timestamp()}
        )
        .select(*FRAUD_ALERTS)
    )
