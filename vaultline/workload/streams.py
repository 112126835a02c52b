"""Streaming queries: land rows derived from the test tables, run to the end, read the sink back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.operators import dedup
from vaultline.operators.rules import Rule, enforce
from vaultline.plans import bronze, refresh, rulebook, silver
from vaultline.schemas import INGESTED_AT, RAW, UPDATED_AT, with_extra
from vaultline.schemas import bronze as bronze_schema
from vaultline.sinks import append_stream, write_json
from vaultline.sources.landing import stream_landing
from vaultline.sources.tables import read_table, stream_table
from vaultline.streaming.batches import write_first
from vaultline.streaming.changes import compact, read_current, write_changes
from vaultline.streaming.run import rule_totals, run_available
from vaultline.streaming.totals import keep_totals, stored_fraud_by_account, stored_tx_metrics
from vaultline.workload import sql
from vaultline.workload.adapter import EXTRA_FIELDS, USER_CHANGES, Bank
from vaultline.workload.batch import CDC_CUSTOMERS_SQL, CURRENT_USERS_SQL, FIRST_SQL, FRAUD_SQL, land_json
from vaultline.workload.registry import query


def _bronze_transactions(bank: Bank, root: str) -> DataFrame:
    write_json(bank.raw("transactions"), f"{root}/landing")
    landed = stream_landing(bank.spark, f"{root}/landing", RAW["transactions"])
    run_available(append_stream(bronze.raw("transactions", landed), f"{root}/bronze", f"{root}/cp_bronze"))
    return read_table(bank.spark, f"{root}/bronze")


def _silver_transactions(bank: Bank, root: str) -> list:
    _bronze_transactions(bank, root)
    stored = stream_table(bank.spark, f"{root}/bronze", bronze_schema("transactions"))
    refined = silver.transactions(stored, metrics="silver")
    return run_available(append_stream(refined, f"{root}/silver", f"{root}/cp_silver"))


@query(
    "stream_bronze_transactions",
    sql.given([sql.RAW_TRANSACTIONS, sql.BRONZE_TRANSACTIONS], "SELECT * FROM bronze_transactions"),
)
def stream_bronze_transactions(bank: Bank) -> DataFrame:
    return _bronze_transactions(bank, bank.scratch("stream")).select(*RAW["transactions"].names)


@query("stream_silver_transactions", sql.given(sql.TRANSACTIONS, "SELECT * FROM transactions"))
def stream_silver_transactions(bank: Bank) -> DataFrame:
    root = bank.scratch("stream")
    _silver_transactions(bank, root)
    return read_table(bank.spark, f"{root}/silver").drop(INGESTED_AT)


@query(
    "stream_expectation_metrics",
    sql.given(
        sql.TRANSACTIONS,
        "SELECT 'rows' AS metric, count(*) AS n FROM clean_transactions "
        "UNION ALL SELECT 'positive amount', count(*) FILTER (WHERE (amount > 0) IS NOT TRUE) "
        "FROM clean_transactions "
        "UNION ALL SELECT 'valid currency', count(*) FILTER (WHERE (currency = 'EUR') IS NOT TRUE) "
        "FROM clean_transactions",
    ),
)
def stream_expectation_metrics(bank: Bank) -> DataFrame:
    totals = rule_totals(_silver_transactions(bank, bank.scratch("stream")), "silver")
    return bank.spark.createDataFrame(list(totals.items()), "metric string, n long")


@query("stream_dedup", f"WITH {FIRST_SQL} SELECT * FROM first_rows WHERE amount > 0")
def stream_dedup(bank: Bank) -> DataFrame:
    """Three runs, one per arrival: the first copy of a key wins, also when a rule then drops it."""
    root = bank.scratch("stream")
    feed = bank.duplicate_feed()
    for arrival in range(3):
        write_json(feed.filter(F.col("arrival") == arrival), f"{root}/landing/arrival_{arrival}")
        landed = bank.spark.readStream.schema(feed.schema).json(f"{root}/landing/*")
        kept = enforce(
            dedup.first_per_key(landed, ["event_id"]), [Rule("positive amount", "amount > 0", drop=True)]
        )
        run_available(append_stream(kept, f"{root}/out", f"{root}/checkpoint"))
    return read_table(bank.spark, f"{root}/out")


@query("stream_dedup_one_trigger", f"WITH {FIRST_SQL} SELECT * FROM first_rows WHERE amount > 0")
def stream_dedup_one_trigger(bank: Bank) -> DataFrame:
    """All arrivals wait for one run: the copy in the file written first wins, however large the later files are."""
    root, feed = bank.scratch("stream"), bank.duplicate_feed()
    for arrival in range(3):
        write_json(feed.filter(F.col("arrival") == arrival), f"{root}/landing/part_{9 - arrival}")
    landed = stream_landing(bank.spark, f"{root}/landing/*", feed.schema)
    positive = [Rule("positive amount", "amount > 0", drop=True)]
    run_available(
        write_first(
            landed, f"{root}/out", f"{root}/checkpoint", ["event_id"], f"{root}/known",
            lambda fresh, _: enforce(fresh.select(*feed.columns), positive),
        )
    )
    return read_table(bank.spark, f"{root}/out", feed.schema)


@query("cdc_stream_customers", CDC_CUSTOMERS_SQL)
def cdc_stream_customers(bank: Bank) -> DataFrame:
    """States of customers land in three runs, with a compaction by buckets after the first two; read by its name."""
    root, states = bank.scratch("stream"), bank.changed_customers()
    raw = with_extra(RAW["customers"], *EXTRA_FIELDS["customers"])
    schema = bronze_schema("customers", *EXTRA_FIELDS["customers"])
    view = "customers_cdc_" + root.rsplit("-", 1)[-1]
    refresh.name_changes(bank.spark, view, refresh.CUSTOMER_CHANGES, f"{root}/customers", schema, "Current customers", {})
    for run in range(3):
        write_json(states.where(F.col("run") == run).drop("run"), f"{root}/landing/run_{run}")
        landed = stream_landing(bank.spark, f"{root}/landing/*", raw)
        run_available(write_changes(landed, refresh.CUSTOMER_CHANGES, f"{root}/customers", f"{root}/checkpoint"))
        if run < 2:
            compact(bank.spark, refresh.CUSTOMER_CHANGES, f"{root}/customers", buckets=8)
    return bank.spark.table(view).drop(INGESTED_AT)


@query("cdc_stream_scd1", CURRENT_USERS_SQL)
def cdc_stream_scd1(bank: Bank) -> DataFrame:
    """Changes land in four interleaved parts out of order, with a compaction halfway."""
    root = bank.scratch("stream")
    events = bank.given("events")
    for run, part in enumerate((2, 0, 3, 1)):
        events.filter(F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(4)) == part).write.parquet(f"{root}/landing/part_{part}")
        landed = stream_table(bank.spark, f"{root}/landing/*", events.schema)
        run_available(write_changes(landed, USER_CHANGES, f"{root}/users", f"{root}/checkpoint"))
        if run == 1:
            compact(bank.spark, USER_CHANGES, f"{root}/users", buckets=8)
    return read_current(bank.spark, USER_CHANGES, f"{root}/users")


@query("refresh_available", FRAUD_SQL)
def refresh_available(bank: Bank) -> DataFrame:
    """Landing JSON through all streaming layers to the stored alerts."""
    root = bank.scratch("refresh")
    land_json(bank, f"{root}/landing")
    refresh.refresh_available(
        bank.spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoints", EXTRA_FIELDS
    )
    return read_table(bank.spark, f"{root}/out/gold/fraud_alerts").drop(UPDATED_AT)


# --- the right to be forgotten, and stored counts ----------------------------------------------

# Customers that are deleted by a second row some time after they landed.
LEAVING = "customer_id % 29 = 0"
LEFT_AT = "2024-06-01T00:00:00"

_LEFT_SQL = f"""left_customers AS (
  SELECT * REPLACE (true AS is_deleted, '{LEFT_AT}' AS created_at) FROM raw_customers
  WHERE CAST(customer_id AS BIGINT) % 29 = 0),
gone AS (SELECT customer_id FROM raw_customers WHERE is_deleted UNION SELECT customer_id FROM left_customers)"""


def _blanked(layer: str, table: str, phone: str = "phone") -> str:
    is_gone = "customer_id IN (SELECT customer_id FROM gone)"
    return (
        f"SELECT '{layer}' AS layer, customer_id, CASE WHEN {is_gone} THEN 'ANONYMIZED' ELSE full_name END AS full_name, "
        f"CASE WHEN {is_gone} THEN 'deleted_' || customer_id || '@anonymized.com' ELSE email END AS email, "
        f"CASE WHEN {is_gone} THEN '0000000000' ELSE {phone} END AS phone FROM {table}"
    )


def land_leaving(bank: Bank, root: str) -> None:
    gone = bank.raw("customers").where(LEAVING)
    left = {"is_deleted": F.lit(True), "created_at": F.lit(LEFT_AT)}
    write_json(gone.withColumns(left), f"{root}/customers/left")


@query(
    "gdpr_stored",
    sql.given(
        sql.CUSTOMERS[:1] + [_LEFT_SQL] + sql.CUSTOMERS[1:],
        sql.union(
            [
                _blanked("bronze", "(SELECT * FROM raw_customers UNION ALL SELECT * FROM left_customers)"),
                _blanked("silver", "customers"),
                _blanked("gold", "customers").replace("'0000000000'", "NULL").replace("ELSE phone", "ELSE NULL"),
            ]
        ),
    ),
)
def gdpr_stored(bank: Bank) -> DataFrame:
    """Deleted customers are blanked in the stored tables of all layers; what is there is read back."""
    root = bank.scratch("forgotten")
    landing, out, checkpoints = (f"{root}/{name}" for name in ("landing", "out", "checkpoints"))
    for entity in ("customers", "accounts", "transactions"):
        write_json(bank.raw(entity), f"{landing}/{entity}/first")
    for later in (False, True):
        if later:
            land_leaving(bank, landing)
        refresh.refresh_available(bank.spark, f"{landing}", out, checkpoints, EXTRA_FIELDS, recursiveFileLookup="true", buckets=8)
    refresh.forget_customers(bank.spark, out, EXTRA_FIELDS)
    tables = {"bronze": "bronze/customers", "silver": "silver/customers", "gold": "gold/customer_360"}
    parts = []
    for layer, folder in tables.items():
        stored = read_table(bank.spark, f"{out}/{folder}")
        phone = F.col("phone") if layer != "gold" else F.lit(None).cast("string").alias("phone")
        parts.append(stored.select(F.lit(layer).alias("layer"), "customer_id", "full_name", "email", phone))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_STORED_RULES = [
    sql.violations(f"{layer}_{entity}", table.format(entity), r.name, r.action, r.predicate)
    for layer, table, book in (("bronze", "raw_{}", rulebook.BRONZE), ("silver", "clean_{}", rulebook.SILVER))
    for entity in ("customers", "accounts", "transactions")
    for r in book[entity]
] + [
    sql.violations(f"bronze_{entity}", f"raw_{entity}", r.name, r.action, r.predicate.replace("_malformed", "NULL").replace("try_to_timestamp(", "try_cast(").replace(") IS NOT NULL", " AS TIMESTAMP) IS NOT NULL"))
    for entity in ("customers", "accounts", "transactions")
    for r in rulebook.LANDED[entity]
]


@query(
    "rule_counts_stored",
    sql.given(sql.SILVER, f"SELECT table_name, rule, total, failed FROM ({sql.union(_STORED_RULES)})"),
)
def rule_counts_stored(bank: Bank) -> DataFrame:
    """The rules' counts of two refreshes, added up from what each batch has stored."""
    root = bank.scratch("counted")
    for half in range(2):
        for entity in ("customers", "accounts", "transactions"):
            key = F.coalesce(F.col(silver.KEYS[entity]), F.lit("none"))
            part = bank.raw(entity).where(F.pmod(F.xxhash64(key), F.lit(2)) == half)
            write_json(part, f"{root}/landing/{entity}/half_{half}")
        refresh.refresh_available(
            bank.spark, f"{root}/landing", f"{root}/out", f"{root}/checkpoints", EXTRA_FIELDS, recursiveFileLookup="true", buckets=8
        )
    counts = refresh.rule_counts(bank.spark, f"{root}/out").groupBy("table_name", "rule")
    return counts.agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))


# --- totals that are kept up to date -------------------------------------------------------------


def _kept_totals(bank: Bank) -> str:
    """Silver transactions arrive in three parts, one of them late; every part brings the totals up to date."""
    root = bank.scratch("totals")
    moves = bank.silver("transactions")
    schema = moves.schema
    for part in (1, 2, 0):
        chosen = F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == part
        moves.where(chosen).write.parquet(f"{root}/silver/part_{part}")
        arrived = stream_table(bank.spark, f"{root}/silver", schema)
        run_available(keep_totals(arrived, f"{root}/totals", f"{root}/checkpoint"))
    return f"{root}/totals"


query("stream_fraud_by_account", sql.given(sql.TRANSACTIONS + [sql.VELOCITY, sql.FRAUD_BY_ACCOUNT], "SELECT * FROM fraud_by_account"))(
    lambda bank: stored_fraud_by_account(bank.spark, _kept_totals(bank))
)
query("stream_tx_metrics", sql.given(sql.TRANSACTIONS + [sql.TX_METRICS], "SELECT * FROM tx_metrics"))(
    lambda bank: stored_tx_metrics(bank.spark, _kept_totals(bank))
)
