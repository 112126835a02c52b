"""Named row rules that either warn or drop, with counts of the rows that break them.

A row satisfies a rule only if the predicate is true; an unknown outcome counts as a violation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from vaultline.functions.derive import is_true


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    drop: bool = False

    @property
    def action(self) -> str:
        return "drop" if self.drop else "warn"

    def violations(self) -> Column:
        return F.count_if(~is_true(F.expr(self.predicate)))


def enforce(
    df: DataFrame, rules: Sequence[Rule], metrics: str | Observation | None = None
) -> DataFrame:
    """Drop what the drop rules reject. With ``metrics``, count every rule's violations on the way.

    Counting sees all input rows, so it keeps the filters from moving into the scan; leave
    ``metrics`` out where only the surviving rows matter.
    """
    if metrics is not None:
        counts = [rule.violations().alias(rule.name) for rule in rules]
        df = df.observe(metrics, F.count(F.lit(1)).alias("rows"), *counts)
    for rule in rules:
        if rule.drop:
            df = df.filter(rule.predicate)
    return df


def report(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule, all counted in a single pass: table_name, rule, action, total, failed."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(rule.violations().alias(f"failed_{i}") for i, rule in enumerate(rules)),
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(rule.name).alias("rule"),
            F.lit(rule.action).alias("action"),
            F.col("total").alias("total"),
            F.col(f"failed_{i}").alias("failed"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))
