"""The quality checks of each raw table."""

from __future__ import annotations

from pyspark.sql import functions as F

from vaultline.operators import quality as q
from vaultline.sources.generator import (
    ACCOUNT_TYPES,
    CHANNELS,
    CURRENCY,
    FRAUD_REASONS,
    KYC_STATUSES,
)

FRAUD_RATE = (0.01, 0.05)


def customers(*counts: q.Check) -> list[q.Check]:
    return [
        *counts,
        q.unique("customer_id"),
        q.not_null("customer_id"),
        q.not_null("email"),
        q.not_null("full_name"),
        q.accepted("kyc_status", KYC_STATUSES),
        q.contains("email", "@"),
        q.is_false("is_deleted"),
    ]


def accounts(*counts: q.Check) -> list[q.Check]:
    return [
        *counts,
        q.unique("account_id"),
        q.at_least("balance", 0),
        q.accepted("currency", (CURRENCY,)),
        q.accepted("account_type", ACCOUNT_TYPES),
        q.not_null("customer_id"),
    ]


def transactions(*counts: q.Check) -> list[q.Check]:
    flagged = F.col("is_flagged_fraud")
    return [
        *counts,
        q.unique("transaction_id"),
        q.above("amount", 0),
        q.accepted("currency", (CURRENCY,)),
        q.accepted("channel", CHANNELS),
        q.rate_between("fraud rate", flagged, *FRAUD_RATE),
        q.implies("fraud has reason", flagged, F.col("fraud_reason").isin(*FRAUD_REASONS)),
        q.implies("no reason without fraud", ~flagged, F.col("fraud_reason").isNull()),
        q.not_null("account_id"),
    ]
