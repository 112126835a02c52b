"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from vaultline.workload.adapter import Bank

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock values, which compare equal whatever zone the reader is in."""
    stamped = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamped})


def query(name: str, oracle: str | None = None) -> Callable[[Callable[[Bank], DataFrame]], Query]:
    def register(build: Callable[[Bank], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return zoneless(build(Bank(spark, sf_dir)))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register
