"""Entity schemas and the fixed column order of every table."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _fields(kind, *names: str) -> list[StructField]:
    return [StructField(name, kind, True) for name in names]


# Landing JSON. Timestamps stay text until the silver layer parses them.
RAW_CUSTOMERS = StructType(
    _fields(StringType(), "customer_id", "full_name", "email", "phone", "kyc_status")
    + _fields(BooleanType(), "is_deleted")
    + _fields(StringType(), "created_at")
)
RAW_ACCOUNTS = StructType(
    _fields(StringType(), "account_id", "customer_id", "account_type")
    + _fields(DoubleType(), "balance")
    + _fields(StringType(), "currency", "status", "opened_at")
)
RAW_TRANSACTIONS = StructType(
    _fields(StringType(), "transaction_id", "account_id", "counterpart_iban")
    + _fields(DoubleType(), "amount")
    + _fields(StringType(), "currency", "transaction_type", "status")
    + _fields(BooleanType(), "is_flagged_fraud")
    + _fields(StringType(), "fraud_reason", "channel", "transaction_date", "created_at")
)
RAW = {
    "customers": RAW_CUSTOMERS,
    "accounts": RAW_ACCOUNTS,
    "transactions": RAW_TRANSACTIONS,
}

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"
SOURCE_TIME = "_source_time"
MALFORMED = "_malformed"
UPDATED_AT = "_updated_at"

LINEAGE = [
    StructField(MALFORMED, StringType(), True),
    StructField(INGESTED_AT, TimestampType(), True),
    StructField(SOURCE_FILE, StringType(), True),
    StructField(SOURCE_TIME, TimestampType(), True),
]


def with_extra(schema: StructType, *extra: StructField) -> StructType:
    return StructType(schema.fields + list(extra))


def bronze(entity: str, *extra: StructField) -> StructType:
    """Stored layout of a bronze table: the raw fields, the text of malformed records, and the lineage."""
    return with_extra(RAW[entity], *extra, *LINEAGE)


# The published column order of the silver and gold tables.
SILVER_CUSTOMERS = (
    "customer_id", "full_name", "email", "phone", "kyc_status", "is_deleted", "created_at", "_ingested_at",
)
SILVER_ACCOUNTS = (
    "account_id", "customer_id", "account_type", "balance", "is_high_balance", "currency", "status",
    "opened_at", "_ingested_at",
)
SILVER_TRANSACTIONS = (
    "transaction_id", "account_id", "transaction_type", "amount", "amount_category", "currency",
    "counterpart_iban", "transaction_date", "status", "is_flagged_fraud", "is_suspicious", "fraud_reason",
    "channel", "created_at", "_ingested_at",
)
CUSTOMER_360 = (
    "customer_id", "full_name", "email", "kyc_status", "is_deleted", "total_accounts", "total_balance",
    "total_transactions", "total_amount_spent", "avg_transaction_amount", "last_transaction_date",
    "total_fraud_count", "risk_score", "_updated_at",
)
FRAUD_ALERTS = (
    "account_id", "customer_id", "full_name", "kyc_status", "total_fraud_txns", "velocity_alerts_count",
    "last_fraud_date", "alert_level", "requires_investigation", "_updated_at",
)
