"""Quality checks over any table, reported as (check_name, total, failed, passed)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.derive import is_true


@dataclass(frozen=True)
class RowCheck:
    """Every row must satisfy the predicate; an unknown outcome fails."""

    name: str
    predicate: Column


@dataclass(frozen=True)
class RateCheck:
    """The share of rows satisfying the predicate must lie within the bounds."""

    name: str
    predicate: Column
    low: float
    high: float


@dataclass(frozen=True)
class CountCheck:
    """The number of rows must lie within the bounds."""

    name: str
    at_least: int
    at_most: int | None = None


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows may share the key; surplus rows fail."""

    name: str
    keys: tuple[str, ...]


Check = RowCheck | RateCheck | CountCheck | UniqueCheck


def row_count(n: int) -> Check:
    return CountCheck(f"row count = {n}", n, n)


def row_count_at_least(n: int) -> Check:
    return CountCheck(f"row count >= {n}", n)


def unique(*keys: str) -> Check:
    return UniqueCheck(f"{', '.join(keys)} unique", keys)


def not_null(column: str) -> Check:
    return RowCheck(f"{column} not null", F.col(column).isNotNull())


def accepted(column: str, values: Sequence[str]) -> Check:
    return RowCheck(f"{column} accepted", F.col(column).isin(*values))


def contains(column: str, text: str) -> Check:
    return RowCheck(f"{column} contains {text}", F.col(column).contains(text))


def is_false(column: str) -> Check:
    return RowCheck(f"{column} is false", ~F.col(column))


def at_least(column: str, bound: float) -> Check:
    return RowCheck(f"{column} >= {bound}", F.col(column) >= bound)


def above(column: str, bound: float) -> Check:
    return RowCheck(f"{column} > {bound}", F.col(column) > bound)


def implies(name: str, condition: Column, then: Column) -> Check:
    return RowCheck(name, ~is_true(condition) | is_true(then))


def rate_between(name: str, predicate: Column, low: float, high: float) -> Check:
    return RateCheck(name, predicate, low, high)


def _line(name: str, failed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.col("total").alias("total"),
        failed.alias("failed"),
        (failed == 0).alias("passed"),
    )


def _unless(condition: Column) -> Column:
    return F.when(is_true(condition), 0).otherwise(1).cast("long")


def _scan(df: DataFrame, checks: Sequence[RowCheck | RateCheck | CountCheck]) -> DataFrame:
    """All checks that look at rows one by one: one pass, and only counts leave the tasks."""
    counts = [F.count(F.lit(1)).alias("total")]
    lines = []
    total = F.col("total")
    for i, check in enumerate(checks):
        n = F.col(f"n_{i}")
        if isinstance(check, RowCheck):
            counts.append(F.count_if(~is_true(check.predicate)).alias(f"n_{i}"))
            lines.append(_line(check.name, n))
        elif isinstance(check, RateCheck):
            counts.append(F.count_if(check.predicate).alias(f"n_{i}"))
            lines.append(_line(check.name, _unless(F.try_divide(n, total).between(check.low, check.high))))
        else:
            enough = total >= check.at_least
            fits = enough if check.at_most is None else enough & (total <= check.at_most)
            lines.append(_line(check.name, _unless(fits)))
    return df.agg(*counts).select(F.inline(F.array(*lines)))


def _surplus(df: DataFrame, check: UniqueCheck) -> DataFrame:
    """Rows beyond the first of each key. Only the key is read and shuffled, counted beforehand."""
    per_key = df.groupBy(*check.keys).agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"),
    )
    return counts.select(F.inline(F.array(_line(check.name, F.col("surplus")))))


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One pass for all checks on single rows, and one over the key for each unique check."""
    by_row = [c for c in checks if not isinstance(c, UniqueCheck)]
    parts = [_scan(df, by_row)] if by_row else []
    parts += [_surplus(df, c) for c in checks if isinstance(c, UniqueCheck)]
    return reduce(DataFrame.unionByName, parts)


def orphans(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Number of child rows whose key is NULL or has no parent: (total, orphans).

    Children are counted per key before they meet the parents, so neither a frequent key nor the
    NULL key concentrates rows in one task.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(key).distinct().withColumn("known", F.lit(True))
    return (
        per_key.join(known, key, "left")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias("orphans"),
        )
    )
