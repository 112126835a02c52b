"""Landing folders to gold tables, as one batch or as a triggered stream run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructField, StructType

from vaultline.operators.changes import ChangeFeed
from vaultline.operators.privacy import forget_rows
from vaultline.plans import bronze, silver
from vaultline.plans.customer_360 import CLUSTER_COLUMNS, customer_360, view_of
from vaultline.plans.fraud_alerts import alerts_of, fraud_alerts
from vaultline.schemas import INGESTED_AT, MALFORMED, RAW, SOURCE_FILE, SOURCE_TIME, with_extra
from vaultline.schemas import bronze as bronze_schema
from vaultline.session import scratch_dir
from vaultline.sinks import (
    clustered,
    exists,
    overwrite,
    register_tagged,
    remove,
    replace_partitions,
    settle,
    switch_table,
)
from vaultline.sources.fields import kept_fields, note_fields
from vaultline.sources.landing import read_landing, stream_landing, unknown_fields
from vaultline.sources.tables import read_table, stream_table
from vaultline.streaming.batches import (
    BATCH,
    BUCKET,
    BUCKETS,
    bucketed,
    fold_ledger,
    start_table,
    write_batches,
    write_first,
)
from vaultline.streaming.changes import compact, name_changes, read_current, read_newest, write_changes
from vaultline.streaming.counts import BatchCounts, read_counts
from vaultline.streaming.run import run_available, run_together
from vaultline.streaming.totals import keep_totals, stored_fraud_by_account, stored_tx_metrics

ENTITIES = tuple(RAW)

# Equal creation times are settled by the time of ingest.
CUSTOMER_CHANGES = ChangeFeed(
    keys=("customer_id",),
    sequence=("try_to_timestamp(created_at)", INGESTED_AT),
    delete_when="is_deleted = true",
    except_columns=(MALFORMED, SOURCE_FILE, SOURCE_TIME),
    deleted_keep=("created_at", "is_deleted", INGESTED_AT),
)

# Catalog name, stored folder, comment and tags of each table.
TABLES = (
    ("raw_customers", "bronze/customers", "Customers as landed", {"quality": "bronze"}),
    ("raw_accounts", "bronze/accounts", "Accounts as landed", {"quality": "bronze"}),
    ("raw_transactions", "bronze/transactions", "Transactions as landed", {"quality": "bronze"}),
    ("customers", "silver/customers", "Clean customers, first arrival", {"quality": "silver", "pii": "true"}),
    ("accounts", "silver/accounts", "Clean accounts", {"quality": "silver"}),
    ("transactions", "silver/transactions", "Clean transactions", {"quality": "silver"}),
    ("customer_360", "gold/customer_360", "Customers with account and transaction totals", {"quality": "gold"}),
    ("fraud_alerts", "gold/fraud_alerts", "Fraud indicators of every active account", {"quality": "gold"}),
)
CUSTOMERS_CDC = "silver/customers_cdc"
CUSTOMERS_CDC_ENTRY = (
    "customers_cdc", "Customers as of their newest change, without the deleted ones", {"quality": "silver", "pii": "true"},
)

RULE_COUNTS = "rule_counts"
TOTALS = "silver/_totals"  # account totals that are kept up to date
FIELD_LOG = "_fields"  # fields found beyond the known ones
LEDGER = "_known"  # beside the silver tables: the keys that each has seen
# Tables in buckets of a key: those that the right to be forgotten rewrites.
BUCKET_KEYS = {"customers": ["customer_id"]}

Extras = dict[str, list[StructField]]
# By layer, entity, and rule (or "rows").
RuleCounts = dict[str, dict[str, dict[str, int]]]


def _raw_schema(entity: str, extras: Extras) -> StructType:
    return with_extra(RAW[entity], *extras.get(entity, []))


def _extra_names(entity: str, extras: Extras) -> list[str]:
    return [f.name for f in extras.get(entity, [])]


def found_extras(spark: SparkSession, landing: str, multi_line: bool = False) -> Extras:
    """The fields that the landed files have beyond the known ones, from one pass over all of them, for a batch run."""
    return {e: unknown_fields(spark, f"{landing}/{e}", RAW[e], multi_line) for e in ENTITIES}


def stored_extras(spark: SparkSession, out: str) -> Extras:
    """The fields beyond the known ones that the runs so far have noted beside the tables."""
    return {e: kept_fields(spark, f"{out}/{FIELD_LOG}/{e}") for e in ENTITIES}


def note_extras(spark: SparkSession, landing: str, out: str, multi_line: bool = False) -> Extras:
    """The same, after a look at the files that landed since."""
    return {e: note_fields(spark, f"{landing}/{e}", RAW[e], f"{out}/{FIELD_LOG}/{e}", multi_line) for e in ENTITIES}


def _silver_schema(spark: SparkSession, entity: str, extras: Extras) -> StructType:
    nothing = spark.createDataFrame([], bronze_schema(entity, *extras.get(entity, [])))
    return silver.table(entity, nothing, _extra_names(entity, extras)).schema


def write_gold(spark: SparkSession, out: str, extras: Extras | None = None, database: str | None = None) -> None:
    """Recompute the gold tables from the stored silver tables.

    Account totals that streams keep up to date are taken as they are. With a ``database`` the gold tables are tables
    of the catalog whose versions are switched, so that no reader ever finds them missing; else they are folders
    that are replaced.
    """
    tables = {
        e: read_table(spark, f"{out}/silver/{e}", _silver_schema(spark, e, extras or {})) for e in ENTITIES
    }
    kept = f"{out}/{TOTALS}"
    if exists(spark, kept):
        view = view_of(tables["customers"], tables["accounts"], stored_tx_metrics(spark, kept))
        alerts = alerts_of(stored_fraud_by_account(spark, kept), tables["accounts"], tables["customers"])
    else:
        view, alerts = customer_360(**tables), fraud_alerts(**tables)
    gold = {"customer_360": clustered(view, *CLUSTER_COLUMNS), "fraud_alerts": alerts}
    entries = {name: (comment, tags) for name, _, comment, tags in TABLES}
    for name, df in gold.items():
        if database:
            switch_table(df, f"{database}.{name}", f"{out}/gold_versions/{name}", *entries[name])
        else:
            overwrite(df, f"{out}/gold/{name}")


def register_tables(
    spark: SparkSession, out: str, database: str = "default", extras: Extras | None = None
) -> None:
    """Give the stored tables their names, comments and tags in the catalog, or let it find files that are new to it.

    The change table is there before any change.
    """
    for name, folder, comment, tags in TABLES:
        if exists(spark, f"{out}/{folder}"):
            register_tagged(spark, f"{database}.{name}", f"{out}/{folder}", comment, tags)
            spark.catalog.refreshTable(f"{database}.{name}")  # files that came since it was named
    name, comment, tags = CUSTOMERS_CDC_ENTRY
    extras = stored_extras(spark, out) if extras is None else extras
    schema = bronze_schema("customers", *extras.get("customers", []))
    name_changes(spark, f"{database}.{name}", CUSTOMER_CHANGES, f"{out}/{CUSTOMERS_CDC}", schema, comment, tags)


def current_customers(spark: SparkSession, out: str) -> DataFrame:
    """The change-capture table: newest state of the customers that are not deleted."""
    return read_current(spark, CUSTOMER_CHANGES, f"{out}/{CUSTOMERS_CDC}")


def compact_customers(spark: SparkSession, out: str) -> int:
    """Keep reading the change-capture table cheap; run it between refreshes, now and then."""
    return compact(spark, CUSTOMER_CHANGES, f"{out}/{CUSTOMERS_CDC}")


def rule_counts(spark: SparkSession, out: str) -> DataFrame:
    """``table_name, batch, rule, total, failed`` of every batch that a stream has taken in."""
    return read_counts(spark, f"{out}/{RULE_COUNTS}")


def fold_keys(spark: SparkSession, out: str) -> int:
    """Gather the known keys of the silver tables in fewer files; run it between refreshes, now and then."""
    return sum(fold_ledger(spark, f"{out}/silver/{LEDGER}/{entity}") for entity in ENTITIES)


# --- the right to be forgotten ------------------------------------------------------------------


def deleted_customers(spark: SparkSession, out: str, extras: Extras | None = None) -> DataFrame:
    """``customer_id`` of the customers that silver flags as deleted, or whose newest change is a delete."""
    silver_customers = read_table(spark, f"{out}/silver/customers", _silver_schema(spark, "customers", extras or {}))
    flagged = silver_customers.where("is_deleted").select("customer_id")
    target = f"{out}/{CUSTOMERS_CDC}"
    if exists(spark, target):
        newest = read_newest(spark, CUSTOMER_CHANGES, target)
        flagged = flagged.union(newest.where(CUSTOMER_CHANGES.is_delete()).select("customer_id"))
    return flagged.where("customer_id is not null").distinct()


def _forget_in(spark: SparkSession, path: str, gone: DataFrame) -> list[str]:
    """Rewrites the folders of a table that hold an identity to forget, and no other; returns them."""
    settle(spark, path)
    if not exists(spark, path):
        return []
    reader = spark.read.option("mergeSchema", True).option("basePath", path)  # all columns any file has
    stored = reader.parquet(path)
    names = [c for c in (BATCH, BUCKET) if c in stored.columns]
    if not names:
        raise ValueError(f"{path} does not lie in buckets; refresh it once more")
    found = forget_rows(stored, gone, "customer_id").where("_forgotten").select(*names).distinct().collect()
    if not found:
        return []
    folders = ["/".join([path, *(f"{c}={row[c]}" for c in names)]) for row in found]
    touched = reader.parquet(*folders)
    rewritten = forget_rows(touched, gone, "customer_id").drop("_forgotten")
    return replace_partitions(rewritten.hint("rebalance", *map(F.col, names)), path, *names)


def forget_customers(
    spark: SparkSession, out: str, extras: Extras | None = None, database: str | None = None
) -> dict[str, list[str]]:
    """Blank the identity of deleted customers in the stored tables; returns the folders rewritten, by table.

    Bronze and silver customers lie in buckets of their id: only folders with a row to blank are written anew,
    a second run finds none. The change table is compacted, which leaves deletes without an identity, and gold is
    made again from silver. Run it between refreshes, when all streams have read what is there; a rewritten
    folder of bronze is read once more by the streams behind it, which know its rows and change nothing. Landed
    files, and the text of malformed records, are the caller's to remove.
    """
    extras = stored_extras(spark, out) if extras is None else extras
    if exists(spark, f"{out}/{CUSTOMERS_CDC}"):
        compact_customers(spark, out)
    path = scratch_dir(spark, "forgotten")  # what is rewritten below must not change what is to be forgotten
    deleted_customers(spark, out, extras).write.parquet(path)
    gone = spark.read.parquet(path)
    rewritten = {
        layer: _forget_in(spark, f"{out}/{layer}/customers", gone) for layer in ("bronze", "silver")
    }
    if any(rewritten.values()):
        write_gold(spark, out, extras, database)
    remove(spark, path)
    return rewritten


# --- runs -----------------------------------------------------------------------------------------


def _overwrite(entity: str, df: DataFrame, path: str, buckets: int) -> None:
    keys = BUCKET_KEYS.get(entity)
    if keys:
        overwrite(bucketed(df, keys, buckets), path, [BUCKET])
    else:
        overwrite(df, path)


def refresh_batch(
    spark: SparkSession,
    landing: str,
    out: str,
    extras: Extras | None = None,
    multi_line: bool = False,
    buckets: int = BUCKETS,
) -> RuleCounts:
    """Rebuild every table from all landed files; returns rows and violations per rule.

    ``multi_line`` is for files that hold one array or one object over several lines. Give it an output folder of its own: a folder that streams write to carries their log.
    """
    extras = extras or {}
    watched = {
        layer: {entity: Observation(f"{layer}_{entity}") for entity in ENTITIES}
        for layer in ("bronze", "silver")
    }
    for entity in ENTITIES:
        landed = read_landing(spark, f"{landing}/{entity}", _raw_schema(entity, extras), multi_line)
        _overwrite(entity, bronze.raw(entity, landed, watched["bronze"][entity]), f"{out}/bronze/{entity}", buckets)
        stored = read_table(spark, f"{out}/bronze/{entity}", bronze_schema(entity, *extras.get(entity, [])))
        names = _extra_names(entity, extras)
        refined = silver.table(entity, stored, names, metrics=watched["silver"][entity])
        _overwrite(entity, refined, f"{out}/silver/{entity}", buckets)
    write_gold(spark, out, extras)
    return {
        layer: {entity: watch.get for entity, watch in tables.items()} for layer, tables in watched.items()
    }


def refresh_available(
    spark: SparkSession,
    landing: str,
    out: str,
    checkpoints: str,
    extras: Extras | None = None,
    multi_line: bool = False,
    buckets: int = BUCKETS,
    database: str | None = None,
    found_fields: bool = False,
    archive: str | None = None,
    **options: str | int,
) -> RuleCounts:
    """Take in the files that landed since the last run and bring every table up to date.

    Returns rows and violations per rule, by layer and entity; ``rule_counts`` has those of all runs, batch by
    batch. The first arrival of a key wins: that of an earlier batch, and in a batch that of the file written
    first. ``multi_line`` is for files that hold one array or one object over several lines. ``buckets`` deals out
    the customers; keep it the same from run to run. ``database`` is for gold, see ``write_gold``. With
    ``found_fields``, fields beyond the known ones are kept from the run that finds them on, without ``extras``.
    ``archive`` is a folder to which landed files go once they are taken in, so that listings stay short (those of the
    last batch go in the next run). ``options`` are those of the file source, such as
    ``maxBytesPerTrigger`` (a number of bytes).
    """
    if found_fields:
        extras = {**note_extras(spark, landing, out, multi_line), **(extras or {})}
    extras = stored_extras(spark, out) if extras is None else extras
    counters = {
        (layer, e): BatchCounts(spark, f"{out}/{RULE_COUNTS}", f"{layer}_{e}") for layer in ("bronze", "silver") for e in ENTITIES
    }

    def stored_schema(entity: str) -> StructType:
        return bronze_schema(entity, *extras.get(entity, []))

    def landed(entity: str) -> DataStreamWriter:
        cleaned = {"cleanSource": "archive", "sourceArchiveDir": f"{archive}/{entity}"} if archive else {}
        files = stream_landing(
            spark, f"{landing}/{entity}", _raw_schema(entity, extras), multi_line, **options, **cleaned
        )
        path, counter = f"{out}/bronze/{entity}", counters["bronze", entity]
        start_table(spark, path, stored_schema(entity), BUCKET_KEYS.get(entity, ()))
        return write_batches(
            files,
            path,
            f"{checkpoints}/bronze/{entity}",
            lambda batch, number: bronze.raw(entity, batch, counter.watch(number)),
            BUCKET_KEYS.get(entity, ()),
            buckets,
            counter.store,
        )

    def stored(entity: str) -> DataFrame:
        return stream_table(spark, f"{out}/bronze/{entity}", stored_schema(entity), **options)

    def refined(entity: str) -> DataStreamWriter:
        names = _extra_names(entity, extras)
        path, counter = f"{out}/silver/{entity}", counters["silver", entity]
        start_table(spark, path, _silver_schema(spark, entity, extras), BUCKET_KEYS.get(entity, ()))
        return write_first(
            silver.needed(entity, stored(entity), names, arrival=True),
            path,
            f"{checkpoints}/silver/{entity}",
            [silver.KEYS[entity]],
            f"{out}/silver/{LEDGER}/{entity}",
            lambda fresh, number: silver.refined(entity, fresh, names, counter.watch(number)),
            bucket_keys=BUCKET_KEYS.get(entity, ()),
            buckets=buckets,
            done=counter.store,
        )

    run_together({entity: landed(entity) for entity in ENTITIES})
    target, checkpoint = f"{out}/{CUSTOMERS_CDC}", f"{checkpoints}/{CUSTOMERS_CDC}"
    changes = write_changes(stored("customers"), CUSTOMER_CHANGES, target, checkpoint)
    run_together({entity: refined(entity) for entity in ENTITIES} | {"customers_cdc": changes})
    moves = stream_table(spark, f"{out}/silver/transactions", _silver_schema(spark, "transactions", extras), **options)
    run_available(keep_totals(moves, f"{out}/{TOTALS}", f"{checkpoints}/{TOTALS}"))
    write_gold(spark, out, extras, database)
    counts: RuleCounts = {"bronze": {}, "silver": {}}
    for (layer, entity), counter in counters.items():
        counts[layer][entity] = counter.totals()
    return counts
