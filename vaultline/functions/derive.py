"""Column expressions behind the derived columns. All of them stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business thresholds.
AMOUNT_BANDS = ((100, "small"), (1000, "medium"), (5000, "large"))
TOP_AMOUNT_BAND = "very_large"
HIGH_BALANCE = 20000
SUSPICIOUS_AMOUNT = 8000
HIGH_RISK_ABOVE = 2
MEDIUM_RISK_AT = 1
CRITICAL_FRAUD_ABOVE = 3
HIGH_FRAUD_ABOVE = 1
MEDIUM_VELOCITY_ABOVE = 3
INVESTIGATED_LEVELS = ("critical", "high")

EXACT_BELOW = 1e15  # from here on a double has no cents


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def parse_timestamp(c: Column | str, strict: bool = False) -> Column:
    """ISO text to timestamp in the session zone; malformed text becomes NULL unless strict."""
    return F.to_timestamp(c) if strict else F.try_to_timestamp(_column(c))


def epoch_second(c: Column | str) -> Column:
    """Whole seconds since the epoch, fractions dropped downwards; accepts zone-less timestamps."""
    return _column(c).cast("timestamp").cast("long")


def upper_trimmed(c: Column | str) -> Column:
    return F.trim(F.upper(_column(c)))


def lower_trimmed(c: Column | str) -> Column:
    return F.trim(F.lower(_column(c)))


def rounded_money(c: Column | str) -> Column:
    return F.round(_column(c), 2)


def banded(c: Column | str, bands: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first band whose upper bound exceeds the value; NULL falls through to ``above``."""
    value, chain = _column(c), F
    for bound, label in bands:
        chain = chain.when(value < bound, label)
    return chain.otherwise(above)


def amount_category(c: Column | str = "amount") -> Column:
    return banded(c, AMOUNT_BANDS, TOP_AMOUNT_BAND)


def is_high_balance(c: Column | str = "balance", above: float = HIGH_BALANCE) -> Column:
    return is_true(_column(c) > above)


def is_suspicious(
    flag: Column | str = "is_flagged_fraud",
    amount: Column | str = "amount",
    above: float = SUSPICIOUS_AMOUNT,
) -> Column:
    return is_true(_column(flag)) | is_true(_column(amount) > above)


def risk_score(
    frauds: Column | str = "total_fraud_count",
    high_above: int = HIGH_RISK_ABOVE,
    medium_at: int = MEDIUM_RISK_AT,
) -> Column:
    """Counts strictly between ``medium_at`` and ``high_above + 1`` score low, as published."""
    n = _column(frauds)
    return F.when(n > high_above, "high").when(n == medium_at, "medium").otherwise("low")


def alert_level(
    frauds: Column | str = "total_fraud_txns",
    velocity: Column | str = "velocity_alerts_count",
) -> Column:
    n, v = _column(frauds), _column(velocity)
    return (
        F.when(n > CRITICAL_FRAUD_ABOVE, "critical")
        .when(n > HIGH_FRAUD_ABOVE, "high")
        .when(v > MEDIUM_VELOCITY_ABOVE, "medium")
        .otherwise("low")
    )


def requires_investigation(level: Column | str = "alert_level") -> Column:
    return is_true(_column(level).isin(*INVESTIGATED_LEVELS))


def cents_and_others(c: Column | str) -> tuple[Column, Column]:
    """Sums of two-decimal money, as decimals, and of the values that have no exact cents: those of EXACT_BELOW
    and more, infinities and NaN."""
    value = _column(c)
    exact = F.abs(value) < EXACT_BELOW
    return F.sum(F.when(exact, value).cast("decimal(18,2)")), F.sum(F.when(~exact, value))


def money_total(cents: Column, others: Column) -> Column:
    cents = cents.cast("double")
    return F.when(others.isNull(), cents).otherwise(others + F.coalesce(cents, F.lit(0.0)))


def money_sum(c: Column | str) -> Column:
    """Sum of two-decimal money that does not depend on the order rows arrive in.

    Values without exact cents are added as doubles.
    """
    return money_total(*cents_and_others(c))
