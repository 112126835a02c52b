"""Transactions of the same account in the trailing 24 hours, both ends included.

A range window with one partition per account puts a busy account into a single task and adds up to
a day of rows again for each row. Here transactions are first counted per account and second, with
map-side partial counts, and time is cut into slots of a week. Of each slot, the last day is also
handed to the next one, which needs it to look back. However many rows an account has, a slot of it
holds no more entries than there are seconds in eight days, and two running totals give the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.derive import epoch_second

# Fixed values.
DAY_SECONDS = 86_400
VELOCITY_LIMIT = 5

SLOT_SECONDS = 7 * DAY_SECONDS


def per_second(transactions: DataFrame) -> DataFrame:
    """Partial results per account and second; the NULL date is a second of its own."""
    return transactions.groupBy("account_id", epoch_second("transaction_date").alias("second")).agg(
        F.count("transaction_id").alias("ids"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_flagged_fraud").alias("frauds"),
        F.max("transaction_date").alias("last_date"),
    )


def handed_on(seconds: DataFrame, span: int = DAY_SECONDS, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Each row in the ``slot`` of its second, and those of a slot's last ``span`` again, not ``own``, in the next one."""
    if slot_seconds < span:
        raise ValueError("a slot must be at least as long as the span it looks back")
    offset = F.pmod(F.col("second"), F.lit(slot_seconds))
    slot = F.col("second") - offset
    own = F.struct(slot.alias("slot"), F.lit(True).alias("own"))
    next_one = F.struct((slot + slot_seconds).alias("slot"), F.lit(False).alias("own"))
    slots = F.when(offset >= slot_seconds - span, F.array(own, next_one)).otherwise(F.array(own))
    return seconds.select("*", F.inline(slots))


def counted(slotted: DataFrame, span: int = DAY_SECONDS) -> DataFrame:
    """The own rows of ``handed_on`` seconds, of which an account has one row in each slot, with ``tx_count_24h``."""
    in_slot = Window.partitionBy("account_id", "slot").orderBy("second")
    entered = F.sum("ids").over(in_slot.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.sum("ids").over(in_slot.rangeBetween(Window.unboundedPreceding, -(span + 1)))
    recent = F.when(F.col("second").isNull(), F.col("ids")).otherwise(entered - F.coalesce(left, F.lit(0)))
    return slotted.withColumn("tx_count_24h", recent).filter("own").drop("slot", "own")


def trailing_counts(
    seconds: DataFrame, span: int = DAY_SECONDS, slot_seconds: int = SLOT_SECONDS
) -> DataFrame:
    """Add ``tx_count_24h``, the ids of the account within ``span`` seconds up to each second."""
    return counted(handed_on(seconds, span, slot_seconds), span)


def is_alert(limit: int = VELOCITY_LIMIT) -> Column:
    return F.col("tx_count_24h") > limit


def velocity(
    transactions: DataFrame, span: int = DAY_SECONDS, limit: int = VELOCITY_LIMIT
) -> DataFrame:
    """Each transaction with ``tx_count_24h`` and ``velocity_alert``."""
    moment = epoch_second("transaction_date")
    ids = transactions.groupBy("account_id", moment.alias("second")).agg(
        F.count("transaction_id").alias("ids")
    )
    counts = trailing_counts(ids, span).select(
        F.col("account_id").alias("_account"), F.col("second").alias("_second"), "tx_count_24h"
    )
    same = F.col("account_id").eqNullSafe(F.col("_account")) & moment.eqNullSafe(F.col("_second"))
    return (
        transactions.join(counts, same)
        .drop("_account", "_second")
        .withColumn("velocity_alert", is_alert(limit))
    )


def fraud_by_account(
    transactions: DataFrame, span: int = DAY_SECONDS, limit: int = VELOCITY_LIMIT
) -> DataFrame:
    """Fraud and velocity totals per account, straight from the per-second counts.

    ``last_fraud_date`` is the last date of any transaction, as published.
    """
    return (
        trailing_counts(per_second(transactions), span)
        .groupBy("account_id")
        .agg(
            F.sum("frauds").alias("total_fraud_txns"),
            F.sum(F.when(is_alert(limit), F.col("rows")).otherwise(0)).alias("velocity_alerts_count"),
            F.max("last_date").alias("last_fraud_date"),
        )
    )
