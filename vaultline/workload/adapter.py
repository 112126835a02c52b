"""Bank entities as projections of the test tables.

The test tables hold no bank data, so customers and accounts are read off ``customer`` and
transactions off ``events``; violations of every rule are planted on the way.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from vaultline.operators.changes import ChangeFeed
from vaultline.plans import bronze, silver
from vaultline.schemas import INGESTED_AT, RAW, SOURCE_FILE
from vaultline.session import scratch_dir
from vaultline.sources.landing import with_lineage

EXTRA = {"customers": ["nationality"], "accounts": ["iban"], "transactions": []}
EXTRA_FIELDS = {e: [StructField(c, StringType(), True) for c in names] for e, names in EXTRA.items()}

USER_CHANGES = ChangeFeed(
    keys=("user_id",),
    sequence=("ts", "event_id"),
    delete_when="event_type = 'error'",
    except_columns=("props",),
)

# The test tables used, and the bank entities as expressions over them.
GIVEN = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

FROM_CUSTOMER = {
    "customer_id": "string(c_custkey)",
    "full_name": "'  ' || c_name || ' '",
    "email": "CASE c_custkey % 50 WHEN 0 THEN NULL WHEN 1 THEN 'noat' || c_custkey "
    "ELSE ' User' || c_custkey || '@Example.COM ' END",
    "phone": "'+336' || lpad(string(c_custkey), 8, '0')",
    "kyc_status": "if(c_custkey % 11 = 0, 'unknown', elt(int(c_custkey % 3) + 1, 'verified', 'pending', 'rejected'))",
    "is_deleted": "if(c_custkey % 23 = 0, NULL, c_custkey % 17 = 0)",
    "created_at": "'2024-01-01T00:00:00'",
    "nationality": "if(c_nationkey = 24, NULL, elt(c_nationkey % 3 + 1, 'FR', 'BE', 'DE'))",
}

FROM_CUSTOMER_ACCOUNT = {
    "account_id": "string(c_custkey)",
    "customer_id": "if(c_custkey % 41 = 0, NULL, string(c_custkey div 3))",
    "account_type": "elt(int(c_custkey % 3) + 1, 'checking', 'savings', 'business')",
    "balance": "c_acctbal * 5",
    "currency": "if(c_custkey % 20 = 0, 'USD', 'EUR')",
    "status": "elt(int(c_custkey % 5) + 1, 'active', 'active', 'active', 'frozen', 'closed')",
    "opened_at": "'2024-01-01T00:00:00'",
    "iban": "'FR76' || lpad(string(c_custkey), 14, '0')",
}

_FRAUD = "event_type = 'error' AND event_id % 10 = 0"
FROM_EVENT = {
    "transaction_id": "if(event_id % 307 = 0, NULL, string(event_id))",
    "account_id": "string(user_id)",
    "counterpart_iban": "'FR76' || lpad(string(event_id), 14, '0')",
    "amount": "CASE WHEN event_id % 211 = 0 THEN -value WHEN event_id % 401 = 0 THEN NULL ELSE value * 30 END",
    "currency": "if(event_id % 101 = 0, 'USD', 'EUR')",
    "transaction_type": "event_type",
    "status": "elt(int(event_id % 4) + 1, 'completed', 'completed', 'pending', 'failed')",
    "is_flagged_fraud": f"if(event_id % 601 = 0, NULL, {_FRAUD})",
    "fraud_reason": f"CASE WHEN {_FRAUD} THEN "
    "elt(int(event_id % 3) + 1, 'unusual_amount', 'unusual_location', 'velocity_check') END",
    "channel": "elt(int(event_id % 4) + 1, 'mobile', 'web', 'atm', 'branch')",
    "transaction_date": "if(event_id % 503 = 0, 'not-a-date', date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\"))",
    "created_at": "'2024-02-01T00:00:00'",
}

_SOURCES = {
    "customers": ("customer", FROM_CUSTOMER),
    "accounts": ("customer", FROM_CUSTOMER_ACCOUNT),
    "transactions": ("events", FROM_EVENT),
}

# Altered copies of events arriving before (0) and after (2) the originals (1).
FEED = (
    "inline(array_compact(array("
    "if(event_id % 89 = 0, struct(event_id, -value AS amount, 0 AS arrival), NULL), "
    "struct(event_id, value * 30 AS amount, 1 AS arrival), "
    "if(event_id % 97 = 0, struct(event_id, value * 60 AS amount, 2 AS arrival), NULL))))"
)

# Altered copies of the bank's rows: some early ones fail a rule, the late ones would pass.
COPY_ALTERS = {"customers": "kyc_status", "accounts": "balance", "transactions": "amount"}
COPY_EARLY = {"customers": "'unknown'", "accounts": "-abs(balance)", "transactions": "-abs(amount)"}
COPY_LATE = {"customers": "'verified'", "accounts": "abs(balance) + 1", "transactions": "abs(amount) + 1"}


# Later states of customers: when they were made, which customers have one, what changes, and in which of
# three runs they land. Some arrive late, some are deletes, some come back, some have no time that can be read.
CUSTOMER_CHANGES = (
    ("'2024-01-01T00:00:00'", "true", {}, 0),
    ("'2024-02-01T00:00:00'", "number % 3 = 0", {"email": "'new' || number || '@mail.test'"}, 1),
    ("'2024-03-01T00:00:00'", "number % 5 = 0", {"is_deleted": "true"}, 1),
    ("'2024-04-01T00:00:00'", "number % 10 = 0", {"is_deleted": "false", "full_name": "'back ' || number"}, 2),
    ("'2023-12-01T00:00:00'", "number % 7 = 0", {"phone": "'too late'"}, 2),
    ("'2024-05-01T00:00:00'", "number % 35 = 0", {"is_deleted": "NULL", "kyc_status": "'pending'"}, 0),
    ("'some day'", "number % 11 = 0", {"full_name": "'never'"}, 2),
)


class Bank:
    """The bank tables of one test-data folder, layer by layer."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def given(self, table: str) -> DataFrame:
        return self.spark.read.schema(GIVEN[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    def landed(self, entity: str) -> DataFrame:
        table, columns = _SOURCES[entity]
        expressions = (f"{expression} AS {name}" for name, expression in columns.items())
        return with_lineage(self.given(table)).selectExpr(*expressions, INGESTED_AT, SOURCE_FILE)

    def raw_columns(self, entity: str) -> list[str]:
        return RAW[entity].names + EXTRA[entity]

    def raw(self, entity: str) -> DataFrame:
        """Without lineage, which costs the scan a column."""
        table, columns = _SOURCES[entity]
        return self.given(table).selectExpr(*(f"{columns[name]} AS {name}" for name in self.raw_columns(entity)))

    def copied(self, entity: str) -> DataFrame:
        """The raw rows and altered copies of some, with ``arrival`` in which they should land."""
        key, altered = silver.KEYS[entity], COPY_ALTERS[entity]
        raw = self.raw(entity).withColumn("number", F.expr(f"try_cast({key} AS long)"))
        parts = [
            raw.where(f"number % {every} = 0").withColumn(altered, F.expr(value)).withColumn("arrival", F.lit(arrival))
            for arrival, every, value in ((0, 13, COPY_EARLY[entity]), (2, 7, COPY_LATE[entity]))
        ]
        return reduce(DataFrame.unionByName, parts, raw.withColumn("arrival", F.lit(1))).drop("number")

    def changed_customers(self) -> DataFrame:
        """All states of the customers, with the ``run`` in which each should land."""
        raw = self.raw("customers").withColumn("number", F.col("customer_id").cast("long"))
        parts = []
        for created, chosen, altered, run in CUSTOMER_CHANGES:
            columns = {"created_at": created, **altered}
            types = {f.name: f.dataType for f in raw.schema.fields}
            part = raw.where(chosen).withColumns({c: F.expr(e).cast(types[c]) for c, e in columns.items()})
            parts.append(part.withColumn("run", F.lit(run)))
        return reduce(DataFrame.unionByName, parts).drop("number")

    def bronze(self, entity: str) -> DataFrame:
        return bronze.raw(entity, self.landed(entity))

    def cleaned(self, entity: str) -> DataFrame:
        return silver.cleaned(entity, self.bronze(entity), EXTRA[entity])

    def silver(self, entity: str) -> DataFrame:
        return silver.table(entity, self.bronze(entity), EXTRA[entity])

    def all_silver(self) -> dict[str, DataFrame]:
        return {entity: self.silver(entity) for entity in _SOURCES}

    def duplicate_feed(self) -> DataFrame:
        return self.given("events").selectExpr(FEED)

    def scratch(self, label: str) -> str:
        return scratch_dir(self.spark, label)
