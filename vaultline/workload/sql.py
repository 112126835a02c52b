"""Independent SQL for the bank entities and tables, as text to prefix a final SELECT with."""

from __future__ import annotations

RAW_CUSTOMERS = """raw_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
         '  ' || c_name || ' ' AS full_name,
         CASE WHEN c_custkey % 50 = 0 THEN NULL
              WHEN c_custkey % 50 = 1 THEN 'noat' || CAST(c_custkey AS VARCHAR)
              ELSE ' User' || CAST(c_custkey AS VARCHAR) || '@Example.COM ' END AS email,
         '+336' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS phone,
         CASE WHEN c_custkey % 11 = 0 THEN 'unknown'
              WHEN c_custkey % 3 = 0 THEN 'verified'
              WHEN c_custkey % 3 = 1 THEN 'pending' ELSE 'rejected' END AS kyc_status,
         CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 17 = 0 END AS is_deleted,
         '2024-01-01T00:00:00' AS created_at,
         CASE WHEN c_nationkey = 24 THEN NULL
              WHEN c_nationkey % 3 = 0 THEN 'FR'
              WHEN c_nationkey % 3 = 1 THEN 'BE' ELSE 'DE' END AS nationality
  FROM customer)"""

RAW_ACCOUNTS = """raw_accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id,
         CASE WHEN c_custkey % 41 = 0 THEN NULL
              ELSE CAST(c_custkey // 3 AS VARCHAR) END AS customer_id,
         CASE WHEN c_custkey % 3 = 0 THEN 'checking'
              WHEN c_custkey % 3 = 1 THEN 'savings' ELSE 'business' END AS account_type,
         c_acctbal * 5 AS balance,
         CASE WHEN c_custkey % 20 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
         CASE WHEN c_custkey % 5 < 3 THEN 'active'
              WHEN c_custkey % 5 = 3 THEN 'frozen' ELSE 'closed' END AS status,
         '2024-01-01T00:00:00' AS opened_at,
         'FR76' || lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS iban
  FROM customer)"""

RAW_TRANSACTIONS = """raw_transactions AS (
  SELECT CASE WHEN event_id % 307 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS transaction_id,
         CAST(user_id AS VARCHAR) AS account_id,
         'FR76' || lpad(CAST(event_id AS VARCHAR), 14, '0') AS counterpart_iban,
         CASE WHEN event_id % 211 = 0 THEN -value
              WHEN event_id % 401 = 0 THEN NULL ELSE value * 30 END AS amount,
         CASE WHEN event_id % 101 = 0 THEN 'USD' ELSE 'EUR' END AS currency,
         event_type AS transaction_type,
         CASE WHEN event_id % 4 = 3 THEN 'failed'
              WHEN event_id % 4 = 2 THEN 'pending' ELSE 'completed' END AS status,
         CASE WHEN event_id % 601 = 0 THEN NULL
              ELSE event_type = 'error' AND event_id % 10 = 0 END AS is_flagged_fraud,
         CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN
              CASE WHEN event_id % 3 = 0 THEN 'unusual_amount'
                   WHEN event_id % 3 = 1 THEN 'unusual_location' ELSE 'velocity_check' END
              END AS fraud_reason,
         CASE WHEN event_id % 4 = 0 THEN 'mobile' WHEN event_id % 4 = 1 THEN 'web'
              WHEN event_id % 4 = 2 THEN 'atm' ELSE 'branch' END AS channel,
         CASE WHEN event_id % 503 = 0 THEN 'not-a-date'
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS transaction_date,
         '2024-02-01T00:00:00' AS created_at
  FROM events)"""

BRONZE_TRANSACTIONS = """bronze_transactions AS (
  SELECT * FROM raw_transactions WHERE transaction_id IS NOT NULL AND account_id IS NOT NULL)"""

CLEAN_CUSTOMERS = """clean_customers AS (
  SELECT customer_id, trim(upper(full_name)) AS full_name, trim(lower(email)) AS email, phone,
         kyc_status, is_deleted, try_cast(created_at AS TIMESTAMP) AS created_at, nationality
  FROM raw_customers)"""

SILVER_CUSTOMERS = """customers AS (
  SELECT * FROM clean_customers WHERE kyc_status IN ('verified', 'pending', 'rejected'))"""

CLEAN_ACCOUNTS = """clean_accounts AS (
  SELECT account_id, customer_id, account_type, round(balance, 2) AS balance,
         coalesce(round(balance, 2) > 20000, false) AS is_high_balance, currency, status,
         try_cast(opened_at AS TIMESTAMP) AS opened_at, iban
  FROM raw_accounts)"""

SILVER_ACCOUNTS = """accounts AS (
  SELECT * FROM clean_accounts WHERE balance >= 0 AND currency = 'EUR')"""

CLEAN_TRANSACTIONS = """clean_transactions AS (
  SELECT transaction_id, account_id, transaction_type, round(amount, 2) AS amount,
         CASE WHEN round(amount, 2) < 100 THEN 'small' WHEN round(amount, 2) < 1000 THEN 'medium'
              WHEN round(amount, 2) < 5000 THEN 'large' ELSE 'very_large' END AS amount_category,
         currency, counterpart_iban, try_cast(transaction_date AS TIMESTAMP) AS transaction_date, status,
         is_flagged_fraud,
         coalesce(is_flagged_fraud, false) OR coalesce(round(amount, 2) > 8000, false) AS is_suspicious,
         fraud_reason, channel, created_at
  FROM bronze_transactions)"""

SILVER_TRANSACTIONS = """transactions AS (
  SELECT * FROM clean_transactions WHERE amount > 0 AND currency = 'EUR')"""

TX_METRICS = """tx_metrics AS (
  SELECT account_id, count(transaction_id) AS total_transactions,
         CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount_spent,
         CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) / count(amount) AS avg_transaction_amount,
         max(transaction_date) AS last_transaction_date,
         CAST(sum(CASE WHEN is_flagged_fraud THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count
  FROM transactions GROUP BY account_id)"""

ACCOUNT_METRICS = """account_metrics AS (
  SELECT customer_id, count(account_id) AS total_accounts,
         CAST(sum(CAST(balance AS DECIMAL(18, 2))) AS DOUBLE) AS total_balance,
         CAST(sum(total_transactions) AS BIGINT) AS total_transactions,
         CAST(sum(CAST(total_amount_spent AS DECIMAL(28, 2))) AS DOUBLE) AS total_amount_spent,
         round(avg(avg_transaction_amount), 6) AS avg_transaction_amount,
         max(last_transaction_date) AS last_transaction_date,
         CAST(sum(fraud_count) AS BIGINT) AS total_fraud_count
  FROM accounts LEFT JOIN tx_metrics USING (account_id) GROUP BY customer_id)"""

SCORED = """scored AS (
  SELECT *, CASE WHEN total_fraud_count > 2 THEN 'high' WHEN total_fraud_count = 1 THEN 'medium'
                 ELSE 'low' END AS risk_score
  FROM account_metrics)"""

CUSTOMER_360 = """customer_360 AS (
  SELECT customer_id, full_name, email, kyc_status, is_deleted, total_accounts, total_balance,
         total_transactions, total_amount_spent, avg_transaction_amount, last_transaction_date,
         total_fraud_count, risk_score
  FROM customers LEFT JOIN scored USING (customer_id))"""

VELOCITY = """velocity AS (
  SELECT *, coalesce(tx_count_24h > 5, false) AS velocity_alert
  FROM (SELECT *, count(transaction_id) OVER (
                    PARTITION BY account_id
                    ORDER BY CAST(floor(epoch(transaction_date)) AS BIGINT)
                    RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS tx_count_24h
        FROM transactions))"""

FRAUD_BY_ACCOUNT = """fraud_by_account AS (
  SELECT account_id,
         CAST(sum(CASE WHEN is_flagged_fraud THEN 1 ELSE 0 END) AS BIGINT) AS total_fraud_txns,
         CAST(sum(CASE WHEN velocity_alert THEN 1 ELSE 0 END) AS BIGINT) AS velocity_alerts_count,
         max(transaction_date) AS last_fraud_date
  FROM velocity GROUP BY account_id)"""

FRAUD_ENRICHED = """fraud_enriched AS (
  SELECT customer_id, account_id, total_fraud_txns, velocity_alerts_count, last_fraud_date,
         full_name, kyc_status
  FROM fraud_by_account
  LEFT JOIN (SELECT account_id, customer_id FROM accounts) USING (account_id)
  LEFT JOIN (SELECT customer_id, full_name, kyc_status FROM customers) USING (customer_id))"""

FRAUD_ALERTS = """fraud_alerts AS (
  SELECT *, alert_level IN ('critical', 'high') AS requires_investigation
  FROM (SELECT *, CASE WHEN total_fraud_txns > 3 THEN 'critical' WHEN total_fraud_txns > 1 THEN 'high'
                       WHEN velocity_alerts_count > 3 THEN 'medium' ELSE 'low' END AS alert_level
        FROM fraud_enriched))"""

MASKED_EMAIL = "left(email, 1) || '***@' || split(email, '@')[2]"
MASKED_PHONE = "left(phone, 4) || '*****' || right(phone, 3)"


def masked_iban(column: str) -> str:
    return f"left({column}, 4) || '***' || right({column}, 3)"


def first_copies(entity: str, key: str, altered: str, early: str, late: str) -> list[str]:
    """The raw rows with the planted copies, cut down to the first arrival of each key."""
    number = f"TRY_CAST({key} AS BIGINT)"
    return [
        f"""copied AS (
  SELECT *, 1 AS arrival FROM raw_{entity}
  UNION ALL SELECT * REPLACE ({early} AS {altered}), 0 FROM raw_{entity} WHERE {number} % 13 = 0
  UNION ALL SELECT * REPLACE ({late} AS {altered}), 2 FROM raw_{entity} WHERE {number} % 7 = 0)""",
        f"""first_{entity} AS (
  SELECT * EXCLUDE (arrival) FROM copied
  QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY arrival) = 1)""",
    ]


def changed_customers(changes) -> str:
    """The states of the customers as planted, one select each."""
    selects = []
    for created, chosen, altered, _ in changes:
        columns = {"created_at": created, **altered}
        number = "CAST(customer_id AS BIGINT)"
        replaced = ", ".join(f"{e.replace('number', number)} AS {c}" for c, e in columns.items())
        selects.append(f"SELECT * REPLACE ({replaced}) FROM raw_customers WHERE {chosen.replace('number', number)}")
    return "changed_customers AS (" + union(selects) + ")"


CURRENT_CUSTOMERS = """current_customers AS (
  SELECT * FROM changed_customers
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY try_cast(created_at AS TIMESTAMP) DESC NULLS LAST) = 1
  AND is_deleted IS DISTINCT FROM true)"""

RAW = [RAW_CUSTOMERS, RAW_ACCOUNTS, RAW_TRANSACTIONS]
CUSTOMERS = [RAW_CUSTOMERS, CLEAN_CUSTOMERS, SILVER_CUSTOMERS]
ACCOUNTS = [RAW_ACCOUNTS, CLEAN_ACCOUNTS, SILVER_ACCOUNTS]
TRANSACTIONS = [RAW_TRANSACTIONS, BRONZE_TRANSACTIONS, CLEAN_TRANSACTIONS, SILVER_TRANSACTIONS]
SILVER = CUSTOMERS + ACCOUNTS + TRANSACTIONS
C360 = SILVER + [TX_METRICS, ACCOUNT_METRICS, SCORED, CUSTOMER_360]
FRAUD = SILVER + [VELOCITY, FRAUD_BY_ACCOUNT, FRAUD_ENRICHED, FRAUD_ALERTS]


def given(parts: list[str], select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def violations(table: str, layer_table: str, rule: str, action: str, predicate: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{action}' AS action, count(*) AS total, "
        f"count(*) FILTER (WHERE ({predicate}) IS NOT TRUE) AS failed FROM {layer_table}"
    )


def check(table: str, name: str, predicate: str) -> str:
    return _checked(table, name, f"count(*) FILTER (WHERE ({predicate}) IS NOT TRUE)")


def check_unique(table: str, key: str) -> str:
    surplus = f"count(*) - count(DISTINCT {key}) - max(CASE WHEN {key} IS NULL THEN 1 ELSE 0 END)"
    return _checked(table, f"{key} unique", surplus)


def check_whole(table: str, name: str, condition: str) -> str:
    return _checked(table, name, f"CASE WHEN {condition} THEN 0 ELSE 1 END")


def _checked(table: str, name: str, failed: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, count(*) AS total, "
        f"CAST({failed} AS BIGINT) AS failed, ({failed}) = 0 AS passed FROM {table}"
    )


def union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


# The generator's hash and the fields made of it.
def draw(row: str, field: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({row} AS VARCHAR) || ':{field}'), 1, 15) AS BIGINT)"


def identifier(row: str, entity: str) -> str:
    digest = f"md5(CAST({row} AS VARCHAR) || ':{entity}_id')"
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return " || '-' || ".join(f"substr({digest}, {start}, {size})" for start, size in cuts)


def pick(row: str, field: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[{draw(row, field)} % {len(values)} + 1]"


def cents(row: str, field: str, low: int, high: int) -> str:
    return f"CAST({draw(row, field)} % {high - low + 1} + {low} AS DOUBLE) / CAST(100 AS DOUBLE)"


def moment(row: str, field: str, start: str, span: int) -> str:
    return (
        f"strftime(TIMESTAMP '{start}' + to_seconds({draw(row, field)} % {span}), '%Y-%m-%dT%H:%M:%S')"
    )


def iban(row: str, field: str) -> str:
    digits = " || ".join(f"lpad(CAST({draw(row, field + part)} AS VARCHAR), 10, '0')" for part in "12")
    return f"'FR76' || {digits} || '000'"
