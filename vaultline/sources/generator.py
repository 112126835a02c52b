"""Synthetic bank records as a Spark source.

Every field is a hash of the row number and the field's name, so rows are made independently on
the executors, a rerun gives the same rows, and foreign keys need neither a join nor a list of ids.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.sinks import write_json

# The vocabularies. A value listed twice is twice as likely.
KYC_STATUSES = ("verified", "pending", "rejected")
ACCOUNT_TYPES = ("checking", "savings", "business")
ACCOUNT_STATUSES = ("active", "active", "active", "frozen", "closed")
TRANSACTION_TYPES = ("transfer", "payment", "withdrawal", "deposit")
TRANSACTION_STATUSES = ("completed", "completed", "pending", "failed")
FRAUD_REASONS = ("unusual_amount", "unusual_location", "velocity_check")
CHANNELS = ("mobile", "web", "atm", "branch")
CURRENCY = "EUR"
FIRST_NAMES = ("Alice", "Bruno", "Camille", "Denis", "Elise", "Fabien", "Gaelle", "Hugo", "Ines", "Jules")
LAST_NAMES = ("Arnaud", "Besson", "Chevalier", "Dupuis", "Fabre", "Girard", "Lambert", "Marchand", "Noel")
MAIL_DOMAINS = ("example.fr", "example.com", "example.org")

# Amounts in cents and the fraud share in percent.
BALANCE_CENTS = (0, 5_000_000)
FRAUD_CENTS = (50_000, 999_900)
REGULAR_CENTS = (100, 300_000)
FRAUD_PERCENT = 3
DEFAULT_CUSTOMERS = 500
DEFAULT_TRANSACTIONS = 5000

ROWS_PER_TASK = 2_000_000
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def row_numbers(spark: SparkSession, n: int) -> DataFrame:
    partitions = max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    return spark.range(0, n, 1, partitions)


def draw(row: Column, field: str) -> Column:
    """A 60-bit number that depends only on the row number and the field name."""
    digest = F.md5(F.concat(row.cast("string"), F.lit(f":{field}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def identifier(row: Column, entity: str) -> Column:
    """The row's id in the usual 8-4-4-4-12 form."""
    digest = F.md5(F.concat(row.cast("string"), F.lit(f":{entity}_id")))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digest, start, size) for start, size in cuts))


def pick(row: Column, field: str, values: Sequence[str]) -> Column:
    position = (draw(row, field) % len(values) + 1).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), position)


def cents(row: Column, field: str, bounds: tuple[int, int]) -> Column:
    low, high = bounds
    return (draw(row, field) % (high - low + 1) + low) / F.lit(100.0)


def moment(row: Column, field: str, start: dt.datetime, end: dt.datetime) -> Column:
    span = max(int((end - start).total_seconds()), 1)
    shifted = F.timestamp_add("SECOND", draw(row, field) % span, F.lit(start).cast("timestamp_ntz"))
    return F.date_format(shifted, ISO_SECONDS)


def iban(row: Column, field: str) -> Column:
    digits = (F.lpad(draw(row, f"{field}{part}").cast("string"), 10, "0") for part in (1, 2))
    return F.concat(F.lit("FR76"), *digits, F.lit("000"))


def _this_year(start: dt.datetime | None, end: dt.datetime | None) -> tuple[dt.datetime, dt.datetime]:
    end = end or dt.datetime.now().replace(microsecond=0)
    return start or dt.datetime(end.year, 1, 1), end


def customers(
    rows: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """One customer per row of ``rows(id)``."""
    start, end = _this_year(start, end)
    row = F.col("id")
    first, last = pick(row, "first_name", FIRST_NAMES), pick(row, "last_name", LAST_NAMES)
    mailbox = F.concat(F.lower(first), F.lit("."), F.lower(last), row.cast("string"))
    return rows.select(
        identifier(row, "customer").alias("customer_id"),
        F.concat_ws(" ", first, last).alias("full_name"),
        F.concat_ws("@", mailbox, pick(row, "mail_domain", MAIL_DOMAINS)).alias("email"),
        F.concat(F.lit("+336"), F.lpad((draw(row, "phone") % 100_000_000).cast("string"), 8, "0")).alias(
            "phone"
        ),
        pick(row, "kyc_status", KYC_STATUSES).alias("kyc_status"),
        F.lit(False).alias("is_deleted"),
        moment(row, "created_at", start, end).alias("created_at"),
    )


def accounts(
    rows: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """One account for each customer of the same ``rows(id)``."""
    start, end = _this_year(start, end)
    row = F.col("id")
    return rows.select(
        identifier(row, "account").alias("account_id"),
        identifier(row, "customer").alias("customer_id"),
        pick(row, "account_type", ACCOUNT_TYPES).alias("account_type"),
        cents(row, "balance", BALANCE_CENTS).alias("balance"),
        F.lit(CURRENCY).alias("currency"),
        pick(row, "account_status", ACCOUNT_STATUSES).alias("status"),
        moment(row, "opened_at", start, end).alias("opened_at"),
    )


def transactions(
    rows: DataFrame,
    account_count: int,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> DataFrame:
    """One transaction per row of ``rows(id)`` on an account numbered below ``account_count``."""
    start, end = _this_year(start, end)
    row = F.col("id")
    fraud = draw(row, "fraud") % 100 < FRAUD_PERCENT
    return rows.select(
        identifier(row, "transaction").alias("transaction_id"),
        identifier(draw(row, "account") % account_count, "account").alias("account_id"),
        iban(row, "counterpart").alias("counterpart_iban"),
        F.when(fraud, cents(row, "fraud_amount", FRAUD_CENTS))
        .otherwise(cents(row, "amount", REGULAR_CENTS))
        .alias("amount"),
        F.lit(CURRENCY).alias("currency"),
        pick(row, "transaction_type", TRANSACTION_TYPES).alias("transaction_type"),
        pick(row, "transaction_status", TRANSACTION_STATUSES).alias("status"),
        fraud.alias("is_flagged_fraud"),
        F.when(fraud, pick(row, "fraud_reason", FRAUD_REASONS)).alias("fraud_reason"),
        pick(row, "channel", CHANNELS).alias("channel"),
        moment(row, "transaction_date", start, end).alias("transaction_date"),
        F.lit(end.isoformat()).alias("created_at"),
    )


def write_landing(
    spark: SparkSession,
    root: str,
    customer_count: int = DEFAULT_CUSTOMERS,
    transaction_count: int = DEFAULT_TRANSACTIONS,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
) -> None:
    """Fill the landing folders below ``root``: customers, an account each, and transactions."""
    people = row_numbers(spark, customer_count)
    made = {
        "customers": customers(people, start, end),
        "accounts": accounts(people, start, end),
        "transactions": transactions(row_numbers(spark, transaction_count), customer_count, start, end),
    }
    for entity, df in made.items():
        write_json(df, f"{root}/{entity}")
