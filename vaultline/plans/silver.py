"""Silver: one typed, cleaned row per key, minus those the drop rules reject.

The same functions serve batches and streams. The first arrival of a key is chosen before any rule
is looked at, so a bad first copy also keeps a good later copy out. Only the raw columns travel
through that step; the derived ones are added behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation

from vaultline.functions import derive
from vaultline.operators.dedup import ARRIVAL, first_per_key
from vaultline.operators.rules import enforce
from vaultline.plans import rulebook
from vaultline.schemas import SILVER_ACCOUNTS, SILVER_CUSTOMERS, SILVER_TRANSACTIONS

KEYS = {"customers": "customer_id", "accounts": "account_id", "transactions": "transaction_id"}
COLUMNS = {
    "customers": SILVER_CUSTOMERS,
    "accounts": SILVER_ACCOUNTS,
    "transactions": SILVER_TRANSACTIONS,
}


def _derived(entity: str, strict: bool) -> list[dict[str, Column]]:
    """Column assignments in order; a later group may use the results of an earlier one."""
    if entity == "customers":
        return [
            {
                "created_at": derive.parse_timestamp("created_at", strict),
                "full_name": derive.upper_trimmed("full_name"),
                "email": derive.lower_trimmed("email"),
            }
        ]
    if entity == "accounts":
        return [
            {
                "opened_at": derive.parse_timestamp("opened_at", strict),
                "balance": derive.rounded_money("balance"),
            },
            {"is_high_balance": derive.is_high_balance()},
        ]
    return [
        {
            "transaction_date": derive.parse_timestamp("transaction_date", strict),
            "amount": derive.rounded_money("amount"),
        },
        {"amount_category": derive.amount_category(), "is_suspicious": derive.is_suspicious()},
    ]


def cleaned(
    entity: str,
    raw: DataFrame,
    extra_columns: Sequence[str] = (),
    strict: bool = False,
    salts: int = 0,
) -> DataFrame:
    """Deduplicated, parsed and derived rows of one entity, before its rules.

    ``salts`` spreads the copies of a key on a stream, see ``first_per_key``.
    """
    rows = first_per_key(needed(entity, raw, extra_columns), [KEYS[entity]], salts=salts)
    return derived(entity, rows, extra_columns, strict)


def needed(entity: str, raw: DataFrame, extra_columns: Sequence[str] = (), arrival: bool | None = None) -> DataFrame:
    """The raw columns that silver is made of, and (by default not on a stream) those that tell who came first."""
    order = ARRIVAL if (not raw.isStreaming if arrival is None else arrival) else ()
    wanted = (*COLUMNS[entity], *extra_columns, *order)
    return raw.select(*(c for c in raw.columns if c in wanted))


def derived(entity: str, firsts: DataFrame, extra_columns: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Parsed and derived columns of rows of which each key has one."""
    for assignments in _derived(entity, strict):
        firsts = firsts.withColumns(assignments)
    return firsts.select(*COLUMNS[entity], *extra_columns)


def table(
    entity: str,
    raw: DataFrame,
    extra_columns: Sequence[str] = (),
    metrics: str | Observation | None = None,
    strict: bool = False,
    salts: int = 0,
) -> DataFrame:
    rows = cleaned(entity, raw, extra_columns, strict, salts)
    return enforce(rows, rulebook.SILVER[entity], metrics)


def refined(
    entity: str,
    firsts: DataFrame,
    extra_columns: Sequence[str] = (),
    metrics: str | Observation | None = None,
    strict: bool = False,
) -> DataFrame:
    """``table`` of rows of which each key has one already, see ``streaming.batches.write_first``."""
    return enforce(derived(entity, firsts, extra_columns, strict), rulebook.SILVER[entity], metrics)


def customers(raw: DataFrame, extra_columns: Sequence[str] = (), **options) -> DataFrame:
    return table("customers", raw, extra_columns, **options)


def accounts(raw: DataFrame, extra_columns: Sequence[str] = (), **options) -> DataFrame:
    return table("accounts", raw, extra_columns, **options)


def transactions(raw: DataFrame, extra_columns: Sequence[str] = (), **options) -> DataFrame:
    return table("transactions", raw, extra_columns, **options)
