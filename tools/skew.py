"""Time the operators on skewed tables: python tools/skew.py [transactions]

One account owns a third of all transactions, a sixth of them are copies of one transaction, and a
third of the accounts have no owner.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vaultline.operators import quality, velocity  # noqa: E402
from vaultline.operators.changes import ChangeFeed, apply_changes  # noqa: E402
from vaultline.plans import checkbook, silver  # noqa: E402
from vaultline.plans.customer_360 import customer_360  # noqa: E402
from vaultline.plans.fraud_alerts import fraud_alerts  # noqa: E402
from vaultline.session import build_session, scratch_dir  # noqa: E402
from vaultline.sources import generator  # noqa: E402

YEAR = (dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31))
FEED = ChangeFeed(("account_id",), ("transaction_date", "transaction_id"), "status = 'failed'", ("_source_file",))


def replaced(column: str, by: str | None, share: float, seed: int):
    return F.when(F.rand(seed) < share, by).otherwise(F.col(column)).alias(column)


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 8_000_000
    people = max(n // 16, 1)
    spark = build_session(
        "skew", "local[8]", **{"spark.sql.shuffle.partitions": "32", "spark.driver.memory": "18g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "skew")

    def timed(label: str, df: DataFrame, path: str | None = None) -> None:
        started = time.perf_counter()
        if path:
            df.write.parquet(f"{root}/{path}")
        else:
            df.write.format("noop").mode("overwrite").save()
        print(f"{label:24} {time.perf_counter() - started:8.2f}s", flush=True)

    rows = spark.range(people)
    accounts = generator.accounts(rows, *YEAR)
    moves = generator.transactions(spark.range(n), people, *YEAR)
    made = {
        "customers": generator.customers(rows, *YEAR),
        "accounts": accounts.withColumn("customer_id", replaced("customer_id", None, 1 / 3, 1)),
        "transactions": moves.withColumn("account_id", replaced("account_id", "hot", 1 / 3, 2)).withColumn(
            "transaction_id", replaced("transaction_id", "copied", 1 / 6, 3)
        ),
    }
    raw, tables = {}, {}
    for entity, df in made.items():
        lineage = {"_ingested_at": F.current_timestamp(), "_source_file": F.lit("made")}
        timed(f"make {entity}", df.withColumns(lineage), f"raw/{entity}")
        raw[entity] = spark.read.parquet(f"{root}/raw/{entity}")
        timed(f"silver {entity}", silver.table(entity, raw[entity]), f"silver/{entity}")
        tables[entity] = spark.read.parquet(f"{root}/silver/{entity}")
    timed("customer_360", customer_360(**tables))
    timed("fraud_alerts", fraud_alerts(**tables))
    timed("velocity", velocity.velocity(tables["transactions"]))
    timed("quality", quality.report(raw["transactions"], checkbook.transactions()))
    timed("change capture", apply_changes(raw["transactions"], FEED))
    timed("orphans", quality.orphans(tables["transactions"], "account_id", tables["accounts"]))


if __name__ == "__main__":
    main()
