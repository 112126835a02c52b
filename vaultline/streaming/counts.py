"""Stored counts of rules: what each batch of a stream had, kept for later questions.

The counts of a table and batch lie in a folder of their own, so a batch that is run again leaves the same rows;
a batch without rows leaves none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from vaultline.sinks.files import exists
from vaultline.streaming.batches import BATCH

ROWS = "rows"
COUNTS = "rule string, total long, failed long"
STORED = f"{COUNTS}, table_name string, {BATCH} int"


class BatchCounts:
    """Takes the counts of one table's batches, stores them below ``root``, and adds up those of this run."""

    def __init__(self, spark: SparkSession, root: str, table: str) -> None:
        self.spark, self.folder = spark, f"{root}/table_name={table}"
        self.watches: dict[int, Observation] = {}
        self.batches: dict[int, dict[str, int]] = {}

    def watch(self, number: int) -> Observation:
        self.watches[number] = Observation()
        return self.watches[number]

    def store(self, number: int) -> None:
        counts = {name: value or 0 for name, value in self.watches.pop(number).get.items()}
        self.batches[number] = counts
        total = counts.get(ROWS, 0)
        rows = [(rule, total, failed) for rule, failed in counts.items() if rule != ROWS and total]
        stored = self.spark.createDataFrame(rows, COUNTS).coalesce(1)
        stored.write.mode("overwrite").parquet(f"{self.folder}/{BATCH}={number}")

    def totals(self) -> dict[str, int]:
        """Rows, and violations per rule, over the batches of this run."""
        added: dict[str, int] = {}
        for counts in self.batches.values():
            for name, value in counts.items():
                added[name] = added.get(name, 0) + value
        return added


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """``table_name, batch, rule, total, failed`` of all batches so far."""
    stored = spark.read.schema(STORED).parquet(root) if exists(spark, root) else spark.createDataFrame([], STORED)
    return stored.select("table_name", BATCH, "rule", "total", "failed")
