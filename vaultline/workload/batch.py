"""Batch queries."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions import derive, masks
from vaultline.operators import changes, dedup, privacy, quality, rollups, rules, velocity
from vaultline.plans import bronze, checkbook, customer_360, fraud_alerts, refresh, rulebook, silver
from vaultline.schemas import INGESTED_AT, MALFORMED, RAW, SOURCE_FILE, UPDATED_AT, with_extra
from vaultline.sinks import create_tagged, overwrite, switch_table, table_tags, write_clustered, write_json
from vaultline.sources import generator, landing
from vaultline.sources.tables import read_table
from vaultline.workload import sql
from vaultline.workload.adapter import (
    COPY_ALTERS,
    COPY_EARLY,
    COPY_LATE,
    CUSTOMER_CHANGES,
    EXTRA,
    EXTRA_FIELDS,
    USER_CHANGES,
    Bank,
)
from vaultline.workload.registry import query

ENTITIES = ("customers", "accounts", "transactions")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# --- bronze -----------------------------------------------------------------------------------


def _bronze(bank: Bank, entity: str) -> DataFrame:
    return bank.bronze(entity).select(*bank.raw_columns(entity))


query("bronze_customers", sql.given([sql.RAW_CUSTOMERS], "SELECT * FROM raw_customers"))(
    lambda bank: _bronze(bank, "customers")
)
query("bronze_accounts", sql.given([sql.RAW_ACCOUNTS], "SELECT * FROM raw_accounts"))(
    lambda bank: _bronze(bank, "accounts")
)
query(
    "bronze_transactions",
    sql.given([sql.RAW_TRANSACTIONS, sql.BRONZE_TRANSACTIONS], "SELECT * FROM bronze_transactions"),
)(lambda bank: _bronze(bank, "transactions"))


def land_json(bank: Bank, root: str) -> None:
    for entity in ENTITIES:
        write_json(bank.raw(entity), f"{root}/{entity}")


@query(
    "json_roundtrip",
    sql.given([sql.RAW_TRANSACTIONS], "SELECT * FROM raw_transactions"),
)
def json_roundtrip(bank: Bank) -> DataFrame:
    path = bank.scratch("json")
    write_json(bank.raw("transactions"), path)
    return landing.read_landing(bank.spark, path, RAW["transactions"]).select(*RAW["transactions"].names)


@query(
    "source_file_counts",
    sql.given(
        sql.RAW,
        sql.union(
            [
                f"SELECT '{e}' AS entity, count(*) AS total, count(*) AS with_file, count(*) AS with_time "
                f"FROM raw_{e}"
                for e in ENTITIES
            ]
        ),
    ),
)
def source_file_counts(bank: Bank) -> DataFrame:
    """Every landed row carries the JSON file it came from and its time of ingest."""
    root = bank.scratch("landing")
    land_json(bank, root)
    from_json = F.col(SOURCE_FILE).endswith(".json")

    def counted(entity: str) -> DataFrame:
        schema = with_extra(RAW[entity], *EXTRA_FIELDS[entity])
        landed = landing.read_landing(bank.spark, f"{root}/{entity}", schema)
        return landed.groupBy(F.lit(entity).alias("entity")).agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(from_json).alias("with_file"),
            F.count(INGESTED_AT).alias("with_time"),
        )

    return union([counted(entity) for entity in ENTITIES])


_TYPE_NAMES = "CASE max(typeof({0})) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'double' END"


@query(
    "infer_schema",
    sql.given(
        sql.RAW,
        sql.union(
            [
                f"SELECT '{entity}' AS entity, '{column}' AS column_name, {_TYPE_NAMES.format(column)} AS data_type "
                f"FROM raw_{entity} HAVING count({column}) > 0"
                for entity in ENTITIES
                for column in RAW[entity].names + EXTRA[entity]
            ]
        ),
    ),
)
def infer_schema(bank: Bank) -> DataFrame:
    root = bank.scratch("landing")
    land_json(bank, root)
    found = [
        (entity, field.name, field.dataType.simpleString())
        for entity in ENTITIES
        for field in landing.infer_schema(bank.spark, f"{root}/{entity}").fields
    ]
    return bank.spark.createDataFrame(found, "entity string, column_name string, data_type string")


# --- silver -----------------------------------------------------------------------------------

query("silver_customers", sql.given(sql.CUSTOMERS, "SELECT * FROM customers"))(
    lambda bank: bank.silver("customers").drop(INGESTED_AT)
)
query("silver_accounts", sql.given(sql.ACCOUNTS, "SELECT * FROM accounts"))(
    lambda bank: bank.silver("accounts").drop(INGESTED_AT)
)
query("silver_transactions", sql.given(sql.TRANSACTIONS, "SELECT * FROM transactions"))(
    lambda bank: bank.silver("transactions").drop(INGESTED_AT)
)


def _silver_with_copies(bank: Bank, entity: str) -> DataFrame:
    """Three arrivals of JSON files, whose names sort the other way; the first copy of a key counts."""
    root, feed = bank.scratch("copies"), bank.copied(entity)
    for arrival in range(3):
        part = feed.where(F.col("arrival") == arrival).drop("arrival")
        write_json(part, f"{root}/landing/part_{9 - arrival}")
    schema = with_extra(RAW[entity], *EXTRA_FIELDS[entity])
    landed = bronze.raw(entity, landing.read_landing(bank.spark, f"{root}/landing/*", schema))
    return silver.table(entity, landed, EXTRA[entity]).drop(INGESTED_AT)


_COPIED = {
    "customers": (sql.CUSTOMERS, "raw_customers"),
    "accounts": (sql.ACCOUNTS, "raw_accounts"),
    "transactions": (sql.TRANSACTIONS, "bronze_transactions"),
}
for _entity, (_parts, _input) in _COPIED.items():
    _firsts = sql.first_copies(
        _entity, silver.KEYS[_entity], COPY_ALTERS[_entity], COPY_EARLY[_entity], COPY_LATE[_entity]
    )
    _cleaned = [part.replace(f"FROM {_input}", f"FROM first_{_entity}") for part in _parts[-2:]]
    if _entity == "transactions":
        _firsts[0] = _firsts[0].replace("FROM raw_transactions", "FROM bronze_transactions")
    query(
        f"silver_{_entity}_with_copies",
        sql.given(_parts[:-2] + _firsts + _cleaned, f"SELECT * FROM {_entity}"),
    )(lambda bank, entity=_entity: _silver_with_copies(bank, entity))


# Every seventh row is broken off, every eleventh has a text for a number, and every row has a new field.
_TORN = "event_id % 7 = 0"
_MISTYPED = "event_id % 7 <> 0 AND event_id % 11 = 0"


@query(
    "bronze_malformed",
    f"""SELECT CASE WHEN {_TORN} THEN NULL ELSE CAST(event_id AS VARCHAR) END AS transaction_id,
       CASE WHEN {_TORN} OR {_MISTYPED} THEN NULL ELSE CAST(event_id AS DOUBLE) END AS amount,
       CASE WHEN {_TORN} THEN NULL ELSE 'till ' || CAST(user_id AS VARCHAR) END AS till,
       CASE WHEN {_TORN} THEN '{{"transaction_id": "' || CAST(event_id AS VARCHAR)
            WHEN {_MISTYPED} THEN '{{"transaction_id": "' || CAST(event_id AS VARCHAR) || '", "amount": "12,50", "till": "till '
                 || CAST(user_id AS VARCHAR) || '"}}' END AS _malformed
FROM events""",
)
def bronze_malformed(bank: Bank) -> DataFrame:
    """Torn records and values of another type keep their text; fields that are not in the schema are found."""
    root = bank.scratch("malformed")
    head = "'{\"transaction_id\": \"' || event_id"
    tail = "', \"till\": \"till ' || user_id || '\"}'"
    bank.given("events").selectExpr(
        f"CASE WHEN {_TORN} THEN {head} WHEN {_MISTYPED} THEN {head} || '\", \"amount\": \"12,50\"' || {tail} "
        f"ELSE {head} || '\", \"amount\": ' || event_id || '.0' || {tail} END AS value"
    ).write.text(f"{root}/transactions")
    known = RAW["transactions"]
    schema = with_extra(known, *landing.unknown_fields(bank.spark, f"{root}/transactions", known))
    landed = landing.read_landing(bank.spark, f"{root}/transactions", schema)
    return landed.select("transaction_id", "amount", "till", MALFORMED)


@query(
    "parse_timestamps",
    sql.given(
        [sql.RAW_TRANSACTIONS],
        "SELECT transaction_id, transaction_date, "
        "try_cast(transaction_date AS TIMESTAMP) AS parsed FROM raw_transactions",
    ),
)
def parse_timestamps(bank: Bank) -> DataFrame:
    return bank.raw("transactions").select(
        "transaction_id",
        "transaction_date",
        derive.parse_timestamp("transaction_date").alias("parsed"),
    )


@query(
    "amount_category_counts",
    sql.given(
        sql.TRANSACTIONS,
        "SELECT amount_category, is_suspicious, count(*) AS n FROM transactions "
        "GROUP BY amount_category, is_suspicious",
    ),
)
def amount_category_counts(bank: Bank) -> DataFrame:
    return (
        bank.silver("transactions")
        .groupBy("amount_category", "is_suspicious")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_SQL_TABLES = {"bronze": "raw_{}", "silver": "clean_{}"}


@query(
    "expectation_report",
    sql.given(
        sql.SILVER,
        sql.union(
            [
                sql.violations(f"{layer}_{entity}", _SQL_TABLES[layer].format(entity), r.name, r.action, r.predicate)
                for layer, book in (("bronze", rulebook.BRONZE), ("silver", rulebook.SILVER))
                for entity in ENTITIES
                for r in book[entity]
            ]
        ),
    ),
)
def expectation_report(bank: Bank) -> DataFrame:
    """Each rule counted on all rows that reach its table, whatever the other rules say."""
    reports = []
    for entity in ENTITIES:
        reports.append(rules.report(bank.landed(entity), rulebook.BRONZE[entity], f"bronze_{entity}"))
        reports.append(rules.report(bank.cleaned(entity), rulebook.SILVER[entity], f"silver_{entity}"))
    return union(reports)


_FEED_SQL = """feed AS (
  SELECT event_id, -value AS amount, 0 AS arrival FROM events WHERE event_id % 89 = 0
  UNION ALL SELECT event_id, value * 30, 1 FROM events
  UNION ALL SELECT event_id, value * 60, 2 FROM events WHERE event_id % 97 = 0)"""
FIRST_SQL = f"""{_FEED_SQL},
first_rows AS (
  SELECT event_id, amount, arrival
  FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY arrival) AS position FROM feed)
  WHERE position = 1)"""

query("dedup_first", f"WITH {FIRST_SQL} SELECT * FROM first_rows")(
    lambda bank: dedup.first_per_key(bank.duplicate_feed(), ["event_id"], ["arrival"])
)

CURRENT_USERS_SQL = """SELECT event_id, ts, user_id, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS position
      FROM events)
WHERE position = 1 AND event_type <> 'error'"""

query("cdc_scd1", CURRENT_USERS_SQL)(
    lambda bank: changes.apply_changes(bank.given("events"), USER_CHANGES)
)


CDC_CUSTOMERS_SQL = sql.given(
    [sql.RAW_CUSTOMERS, sql.changed_customers(CUSTOMER_CHANGES), sql.CURRENT_CUSTOMERS],
    "SELECT * FROM current_customers",
)


@query("cdc_customers", CDC_CUSTOMERS_SQL)
def cdc_customers(bank: Bank) -> DataFrame:
    """Customers as of their newest state: updates, deletes, returns, late rows and times that can't be read."""
    landed = bank.changed_customers().drop("run").withColumn(INGESTED_AT, F.current_timestamp())
    return changes.apply_changes(landed, refresh.CUSTOMER_CHANGES).drop(INGESTED_AT)


# --- gold -------------------------------------------------------------------------------------

query("tx_metrics", sql.given(sql.TRANSACTIONS + [sql.TX_METRICS], "SELECT * FROM tx_metrics"))(
    lambda bank: rollups.tx_metrics(bank.silver("transactions"))
)


@query(
    "accounts_with_tx_metrics",
    sql.given(
        sql.ACCOUNTS + sql.TRANSACTIONS + [sql.TX_METRICS],
        "SELECT account_id, customer_id, balance, total_transactions, total_amount_spent, "
        "avg_transaction_amount, last_transaction_date, fraud_count "
        "FROM accounts LEFT JOIN tx_metrics USING (account_id)",
    ),
)
def accounts_with_tx_metrics(bank: Bank) -> DataFrame:
    accounts = bank.silver("accounts").select("account_id", "customer_id", "balance")
    return rollups.accounts_with_tx_metrics(accounts, rollups.tx_metrics(bank.silver("transactions")))


@query(
    "account_metrics",
    sql.given(
        sql.ACCOUNTS + sql.TRANSACTIONS + [sql.TX_METRICS, sql.ACCOUNT_METRICS],
        "SELECT * FROM account_metrics",
    ),
)
def account_metrics(bank: Bank) -> DataFrame:
    return rounded_mean(
        rollups.account_metrics(bank.silver("accounts"), rollups.tx_metrics(bank.silver("transactions")))
    )


@query(
    "risk_score",
    sql.given(
        sql.ACCOUNTS + sql.TRANSACTIONS + [sql.TX_METRICS, sql.ACCOUNT_METRICS, sql.SCORED],
        "SELECT customer_id, total_fraud_count, risk_score FROM scored",
    ),
)
def risk_score(bank: Bank) -> DataFrame:
    scored = customer_360.scored_accounts(bank.silver("accounts"), bank.silver("transactions"))
    return scored.select("customer_id", "total_fraud_count", "risk_score")


def rounded_mean(df: DataFrame) -> DataFrame:
    """Means of doubles depend on the order of the rows in their last digits."""
    return df.withColumn("avg_transaction_amount", F.round("avg_transaction_amount", 6))


def _customer_360(bank: Bank) -> DataFrame:
    return rounded_mean(customer_360.customer_360(**bank.all_silver()).drop(UPDATED_AT))


C360_SQL = sql.given(sql.C360, "SELECT * FROM customer_360")
query("customer_360", C360_SQL)(_customer_360)


@query(
    "velocity_24h",
    sql.given(
        sql.TRANSACTIONS + [sql.VELOCITY],
        "SELECT transaction_id, account_id, transaction_date, tx_count_24h, velocity_alert FROM velocity",
    ),
)
def velocity_24h(bank: Bank) -> DataFrame:
    moves = bank.silver("transactions").select("transaction_id", "account_id", "transaction_date")
    return velocity.velocity(moves)


@query(
    "velocity_hot_account",
    sql.given(
        sql.TRANSACTIONS[:-1]
        + [
            "transactions AS (SELECT * REPLACE (CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 "
            "THEN 'hot' ELSE account_id END AS account_id) "
            "FROM clean_transactions WHERE amount > 0 AND currency = 'EUR')",
            sql.VELOCITY,
            sql.FRAUD_BY_ACCOUNT,
        ],
        "SELECT * FROM fraud_by_account",
    ),
)
def velocity_hot_account(bank: Bank) -> DataFrame:
    """The fraud totals when one account owns a third of all transactions."""
    hot = F.col("transaction_id").cast("long") % 3 == 0
    skewed = F.when(hot, "hot").otherwise(F.col("account_id"))
    return velocity.fraud_by_account(bank.silver("transactions").withColumn("account_id", skewed))


query(
    "fraud_by_account",
    sql.given(sql.TRANSACTIONS + [sql.VELOCITY, sql.FRAUD_BY_ACCOUNT], "SELECT * FROM fraud_by_account"),
)(lambda bank: velocity.fraud_by_account(bank.silver("transactions")))

query("fraud_enriched", sql.given(sql.FRAUD[:-1], "SELECT * FROM fraud_enriched"))(
    lambda bank: fraud_alerts.fraud_enriched(
        velocity.fraud_by_account(bank.silver("transactions")),
        bank.silver("accounts"),
        bank.silver("customers"),
    )
)


def _fraud_alerts(bank: Bank) -> DataFrame:
    return fraud_alerts.fraud_alerts(**bank.all_silver()).drop(UPDATED_AT)


FRAUD_SQL = sql.given(sql.FRAUD, "SELECT * FROM fraud_alerts")
query("fraud_alerts", FRAUD_SQL)(_fraud_alerts)


# --- sinks ------------------------------------------------------------------------------------


@query("sink_roundtrip", sql.given(sql.ACCOUNTS, "SELECT * FROM accounts"))
def sink_roundtrip(bank: Bank) -> DataFrame:
    path = bank.scratch("accounts")
    overwrite(bank.silver("accounts"), path)
    return read_table(bank.spark, path).drop(INGESTED_AT)


@query("sink_clustered", C360_SQL)
def sink_clustered(bank: Bank) -> DataFrame:
    path = bank.scratch("customer_360")
    write_clustered(_customer_360(bank), path, *customer_360.CLUSTER_COLUMNS)
    return read_table(bank.spark, path)


@query(
    "table_tags",
    sql.given(
        sql.CUSTOMERS,
        "SELECT customer_id, kyc_status, 'silver' AS quality, 'true' AS pii FROM customers",
    ),
)
def table_tags_query(bank: Bank) -> DataFrame:
    """The stored customers next to the tags their table carries in the catalog."""
    path = bank.scratch("tagged")
    table = "tagged_" + path.rsplit("-", 1)[-1]
    customers = bank.silver("customers").select("customer_id", "kyc_status")
    create_tagged(customers, table, path, "Cleaned customers data", {"quality": "silver", "pii": "true"})
    tags = table_tags(bank.spark, table)
    stored = bank.spark.table(table)
    return stored.withColumns({tag: F.lit(tags.get(tag)) for tag in ("quality", "pii")})


@query("sink_switched", C360_SQL)
def sink_switched(bank: Bank) -> DataFrame:
    """The customer view, written three times as versions of a catalog table; the last one is read by its name."""
    root = bank.scratch("switched")
    table = "switched_" + root.rsplit("-", 1)[-1]
    for part in ("customer_id < 'C'", "risk_score IS NULL", "true"):
        switch_table(_customer_360(bank).where(part), table, root, "Customers in versions", {"quality": "gold"})
    return bank.spark.table(table)


@query("refresh_batch", C360_SQL)
def refresh_batch(bank: Bank) -> DataFrame:
    """Landing JSON through bronze and silver files to the stored customer view."""
    root = bank.scratch("refresh")
    land_json(bank, f"{root}/landing")
    refresh.refresh_batch(bank.spark, f"{root}/landing", f"{root}/out", EXTRA_FIELDS)
    return rounded_mean(read_table(bank.spark, f"{root}/out/gold/customer_360").drop(UPDATED_AT))


# --- privacy ----------------------------------------------------------------------------------

NOBODY: tuple[str, ...] = ()

query("mask_email", sql.given(sql.CUSTOMERS, f"SELECT customer_id, {sql.MASKED_EMAIL} AS email FROM customers"))(
    lambda bank: bank.silver("customers").select("customer_id", masks.mask_email("email").alias("email"))
)
query("mask_phone", sql.given(sql.CUSTOMERS, f"SELECT customer_id, {sql.MASKED_PHONE} AS phone FROM customers"))(
    lambda bank: bank.silver("customers").select("customer_id", masks.mask_phone("phone").alias("phone"))
)
query("mask_iban", sql.given(sql.ACCOUNTS, f"SELECT account_id, {sql.masked_iban('iban')} AS iban FROM accounts"))(
    lambda bank: bank.silver("accounts").select("account_id", masks.mask_iban("iban").alias("iban"))
)

MASKED_CUSTOMERS_SQL = f"SELECT * REPLACE ({sql.MASKED_EMAIL} AS email, {sql.MASKED_PHONE} AS phone) FROM customers"


@query("masked_customers", sql.given(sql.CUSTOMERS, MASKED_CUSTOMERS_SQL))
def masked_customers(bank: Bank) -> DataFrame:
    masks_only = privacy.TablePolicy(masks=privacy.POLICIES["customers"].masks)
    return privacy.secure_view(bank.silver("customers"), masks_only, NOBODY).drop(INGESTED_AT)


@query(
    "masked_accounts",
    sql.given(sql.ACCOUNTS, f"SELECT * REPLACE ({sql.masked_iban('iban')} AS iban) FROM accounts"),
)
def masked_accounts(bank: Bank) -> DataFrame:
    return privacy.secure_views(bank.all_silver(), NOBODY)["accounts"].drop(INGESTED_AT)


@query(
    "masked_transactions",
    sql.given(
        sql.TRANSACTIONS,
        f"SELECT * REPLACE ({sql.masked_iban('counterpart_iban')} AS counterpart_iban) FROM transactions",
    ),
)
def masked_transactions(bank: Bank) -> DataFrame:
    policy = privacy.POLICIES["transactions"]
    return privacy.secure_view(bank.silver("transactions"), policy, NOBODY).drop(INGESTED_AT)


READERS = {
    "fr": (("data-analysts-fr",), f"{MASKED_CUSTOMERS_SQL} WHERE nationality = 'FR'"),
    "be": (("data-analysts-be",), f"{MASKED_CUSTOMERS_SQL} WHERE nationality = 'BE'"),
    "fr_be": (
        ("data-analysts-be", "data-analysts-fr"),
        f"{MASKED_CUSTOMERS_SQL} WHERE nationality = 'FR'",
    ),
    "engineer": (("data-engineers", "data-analysts-fr"), "SELECT * FROM customers"),
    "none": (NOBODY, f"{MASKED_CUSTOMERS_SQL} WHERE false"),
}
for _reader, (_groups, _select) in READERS.items():
    query(f"rls_customers_{_reader}", sql.given(sql.CUSTOMERS, _select))(
        lambda bank, groups=_groups: privacy.secure_view(
            bank.silver("customers"), privacy.POLICIES["customers"], groups
        ).drop(INGESTED_AT)
    )

@query("rls_membership", sql.given(sql.CUSTOMERS, READERS["be"][1]))
def rls_membership(bank: Bank) -> DataFrame:
    """A lasting view that looks up the groups of whoever reads it."""
    path = bank.scratch("secured")
    name = "customers_" + path.rsplit("-", 1)[-1]
    create_tagged(bank.silver("customers").drop(INGESTED_AT), name, f"{path}/customers", "Customers", {"pii": "true"})
    groups = F.explode(F.array(F.lit("data-analysts-be"), F.lit("night-shift"))).alias("group_name")
    members = bank.spark.range(1).select(F.expr("session_user()").alias("user_name"), groups)
    others = bank.silver("customers").select("customer_id", F.lit("data-engineers"))
    create_tagged(members.union(others), f"{name}_members", f"{path}/members", "Who is in which group", {})
    views = privacy.secure_in_catalog(
        bank.spark, {"customers": name}, f"{name}_members", {"customers": privacy.POLICIES["customers"]}
    )
    return bank.spark.table(views["customers"])


query(
    "gdpr_anonymize",
    sql.given(
        sql.CUSTOMERS,
        "SELECT * REPLACE (CASE WHEN is_deleted THEN 'ANONYMIZED' ELSE full_name END AS full_name, "
        "CASE WHEN is_deleted THEN 'deleted_' || customer_id || '@anonymized.com' ELSE email END AS email, "
        "CASE WHEN is_deleted THEN '0000000000' ELSE phone END AS phone) FROM customers",
    ),
)(lambda bank: privacy.anonymize(bank.silver("customers")).drop(INGESTED_AT))


# --- quality ----------------------------------------------------------------------------------

_KYC = "kyc_status IN ('verified', 'pending', 'rejected')"
_REASONS = "fraud_reason IN ('unusual_amount', 'unusual_location', 'velocity_check')"


def _checks_sql(prefix: str) -> list[str]:
    c, a, t = (f"{prefix}_{entity}" for entity in ENTITIES)
    rate = "count(*) FILTER (WHERE is_flagged_fraud) / count(*) BETWEEN 0.01 AND 0.05"
    return [
        sql.check_unique(c, "customer_id"),
        sql.check(c, "customer_id not null", "customer_id IS NOT NULL"),
        sql.check(c, "email not null", "email IS NOT NULL"),
        sql.check(c, "full_name not null", "full_name IS NOT NULL"),
        sql.check(c, "kyc_status accepted", _KYC),
        sql.check(c, "email contains @", "contains(email, '@')"),
        sql.check(c, "is_deleted is false", "NOT is_deleted"),
        sql.check_unique(a, "account_id"),
        sql.check(a, "balance >= 0", "balance >= 0"),
        sql.check(a, "currency accepted", "currency = 'EUR'"),
        sql.check(a, "account_type accepted", "account_type IN ('checking', 'savings', 'business')"),
        sql.check(a, "customer_id not null", "customer_id IS NOT NULL"),
        sql.check_unique(t, "transaction_id"),
        sql.check(t, "amount > 0", "amount > 0"),
        sql.check(t, "currency accepted", "currency = 'EUR'"),
        sql.check(t, "channel accepted", "channel IN ('mobile', 'web', 'atm', 'branch')"),
        sql.check_whole(t, "fraud rate", rate),
        sql.check(t, "fraud has reason", f"NOT coalesce(is_flagged_fraud, false) OR {_REASONS}"),
        sql.check(
            t, "no reason without fraud", "coalesce(is_flagged_fraud, true) OR fraud_reason IS NULL"
        ),
        sql.check(t, "account_id not null", "account_id IS NOT NULL"),
    ]


def _quality(tables: dict[str, DataFrame], counts: dict[str, list[quality.Check]]) -> DataFrame:
    books = {
        "customers": checkbook.customers,
        "accounts": checkbook.accounts,
        "transactions": checkbook.transactions,
    }
    return union(
        [
            quality.report(df, books[name.split("_")[-1]](*counts[name])).withColumn(
                "table_name", F.lit(name)
            )
            for name, df in tables.items()
        ]
    )


@query(
    "quality_report",
    sql.given(
        sql.RAW,
        sql.union(
            _checks_sql("raw")
            + [sql.check_whole(f"raw_{e}", "row count >= 100", "count(*) >= 100") for e in ENTITIES]
        ),
    ),
)
def quality_report(bank: Bank) -> DataFrame:
    tables = {f"raw_{entity}": bank.raw(entity) for entity in ENTITIES}
    return _quality(tables, {name: [quality.row_count_at_least(100)] for name in tables})


@query(
    "orphan_counts",
    sql.given(
        sql.CUSTOMERS + sql.ACCOUNTS + sql.TRANSACTIONS,
        "SELECT 'accounts' AS child, count(*) AS total, count(*) FILTER (WHERE customer_id IS NULL OR "
        "customer_id NOT IN (SELECT customer_id FROM customers)) AS orphans FROM accounts "
        "UNION ALL SELECT 'transactions', count(*), count(*) FILTER (WHERE account_id IS NULL OR "
        "account_id NOT IN (SELECT account_id FROM accounts)) FROM transactions",
    ),
)
def orphan_counts(bank: Bank) -> DataFrame:
    silver = bank.all_silver()
    pairs = [("accounts", "customer_id", "customers"), ("transactions", "account_id", "accounts")]
    return union(
        [
            quality.orphans(silver[child], key, silver[parent]).select(
                F.lit(child).alias("child"), "total", "orphans"
            )
            for child, key, parent in pairs
        ]
    )


# --- generator --------------------------------------------------------------------------------

START, END = dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31)
_SPAN = int((END - START).total_seconds())
_START_SQL = "2024-01-01 00:00:00"


def _ids(bank: Bank, table: str, key: str) -> DataFrame:
    return bank.given(table).select(F.col(key).alias("id"))


def _generated(bank: Bank) -> dict[str, DataFrame]:
    people, moves = _ids(bank, "customer", "c_custkey"), _ids(bank, "events", "event_id")
    return {
        "gen_customers": generator.customers(people, START, END),
        "gen_accounts": generator.accounts(people, START, END),
        "gen_transactions": generator.transactions(moves, people.count(), START, END),
    }


_GEN_FRAUD = f"{sql.draw('event_id', 'fraud')} % 100 < 3"
GEN_SQL = [
    f"""gen_customers AS (
  SELECT {sql.identifier('c_custkey', 'customer')} AS customer_id,
         {sql.pick('c_custkey', 'first_name', generator.FIRST_NAMES)} || ' ' ||
         {sql.pick('c_custkey', 'last_name', generator.LAST_NAMES)} AS full_name,
         lower({sql.pick('c_custkey', 'first_name', generator.FIRST_NAMES)}) || '.' ||
         lower({sql.pick('c_custkey', 'last_name', generator.LAST_NAMES)}) ||
         CAST(c_custkey AS VARCHAR) || '@' ||
         {sql.pick('c_custkey', 'mail_domain', generator.MAIL_DOMAINS)} AS email,
         '+336' || lpad(CAST({sql.draw('c_custkey', 'phone')} % 100000000 AS VARCHAR), 8, '0') AS phone,
         {sql.pick('c_custkey', 'kyc_status', generator.KYC_STATUSES)} AS kyc_status,
         false AS is_deleted,
         {sql.moment('c_custkey', 'created_at', _START_SQL, _SPAN)} AS created_at
  FROM customer)""",
    f"""gen_accounts AS (
  SELECT {sql.identifier('c_custkey', 'account')} AS account_id,
         {sql.identifier('c_custkey', 'customer')} AS customer_id,
         {sql.pick('c_custkey', 'account_type', generator.ACCOUNT_TYPES)} AS account_type,
         {sql.cents('c_custkey', 'balance', 0, 5000000)} AS balance,
         'EUR' AS currency,
         {sql.pick('c_custkey', 'account_status', generator.ACCOUNT_STATUSES)} AS status,
         {sql.moment('c_custkey', 'opened_at', _START_SQL, _SPAN)} AS opened_at
  FROM customer)""",
    f"""gen_transactions AS (
  SELECT {sql.identifier('event_id', 'transaction')} AS transaction_id,
         {sql.identifier(f"({sql.draw('event_id', 'account')} % (SELECT count(*) FROM customer))", 'account')}
         AS account_id,
         {sql.iban('event_id', 'counterpart')} AS counterpart_iban,
         CASE WHEN {_GEN_FRAUD} THEN {sql.cents('event_id', 'fraud_amount', 50000, 999900)}
              ELSE {sql.cents('event_id', 'amount', 100, 300000)} END AS amount,
         'EUR' AS currency,
         {sql.pick('event_id', 'transaction_type', generator.TRANSACTION_TYPES)} AS transaction_type,
         {sql.pick('event_id', 'transaction_status', generator.TRANSACTION_STATUSES)} AS status,
         {_GEN_FRAUD} AS is_flagged_fraud,
         CASE WHEN {_GEN_FRAUD} THEN {sql.pick('event_id', 'fraud_reason', generator.FRAUD_REASONS)} END
         AS fraud_reason,
         {sql.pick('event_id', 'channel', generator.CHANNELS)} AS channel,
         {sql.moment('event_id', 'transaction_date', _START_SQL, _SPAN)} AS transaction_date,
         '2024-12-31T00:00:00' AS created_at
  FROM events)""",
]

for _i, _name in enumerate(("gen_customers", "gen_accounts", "gen_transactions")):
    query(_name, sql.given([GEN_SQL[_i]], f"SELECT * FROM {_name}"))(
        lambda bank, name=_name: _generated(bank)[name]
    )

query("quality_generated", sql.given(GEN_SQL, sql.union(_checks_sql("gen"))))(
    lambda bank: _quality(tables := _generated(bank), {name: [] for name in tables})
)
