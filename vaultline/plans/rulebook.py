"""The rules of each table."""

from __future__ import annotations

from vaultline.operators.rules import Rule
from vaultline.schemas import MALFORMED


def _landed(*times: str) -> tuple[Rule, ...]:
    parsable = (Rule(f"{c} parsable", f"{c} IS NULL OR try_to_timestamp({c}) IS NOT NULL") for c in times)
    return (Rule("well formed", f"{MALFORMED} IS NULL"), *parsable)


# What the files themselves are warned about, beside the rules of the bronze tables.
LANDED = {
    "customers": _landed("created_at"),
    "accounts": _landed("opened_at"),
    "transactions": _landed("transaction_date"),
}

BRONZE = {
    "customers": (
        Rule("customer_id not null", "customer_id IS NOT NULL"),
        Rule("email not null", "email IS NOT NULL"),
    ),
    "accounts": (
        Rule("account_id not null", "account_id IS NOT NULL"),
        Rule("customer_id not null", "customer_id IS NOT NULL"),
    ),
    "transactions": (
        Rule("transaction_id not null", "transaction_id IS NOT NULL", drop=True),
        Rule("account_id not null", "account_id IS NOT NULL", drop=True),
        Rule("amount positive", "amount > 0"),
    ),
}

SILVER = {
    "customers": (
        Rule("valid kyc_status", "kyc_status IN ('verified', 'pending', 'rejected')", drop=True),
    ),
    "accounts": (
        Rule("positive balance", "balance >= 0", drop=True),
        Rule("valid currency", "currency = 'EUR'", drop=True),
    ),
    "transactions": (
        Rule("positive amount", "amount > 0", drop=True),
        Rule("valid currency", "currency = 'EUR'", drop=True),
    ),
}
