import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vaultline.operators import dedup
from vaultline.operators.changes import apply_changes
from vaultline.plans import refresh, rulebook, silver
from vaultline.schemas import INGESTED_AT, RAW, UPDATED_AT
from vaultline.schemas import bronze as bronze_schema
from vaultline.sinks import append_stream
from vaultline.sources.landing import stream_landing
from vaultline.sources.tables import read_table, stream_table
from vaultline.streaming.changes import read_current
from vaultline.streaming.run import run_available, run_together
from vaultline.workload.adapter import EXTRA, EXTRA_FIELDS, Bank

ENTITIES = ("customers", "accounts", "transactions")


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).count() == 0 == right.exceptAll(left).count()


def test_every_silver_table_is_the_same_from_batch_and_stream(spark, sf_dir, scratch):
    bank = Bank(spark, sf_dir)
    for entity in ENTITIES:
        bank.bronze(entity).repartition(3).write.parquet(f"{scratch}/bronze/{entity}")
        schema = bronze_schema(entity, *EXTRA_FIELDS[entity])
        stored = stream_table(spark, f"{scratch}/bronze/{entity}", schema, maxFilesPerTrigger=1)
        refined = silver.table(entity, stored, EXTRA[entity])
        progress = run_available(append_stream(refined, f"{scratch}/{entity}", f"{scratch}/cp/{entity}"))
        assert len([p for p in progress if p.numInputRows]) == 3
        batch = silver.table(entity, read_table(spark, f"{scratch}/bronze/{entity}"), EXTRA[entity])
        assert same(read_table(spark, f"{scratch}/{entity}").drop(INGESTED_AT), batch.drop(INGESTED_AT))


def test_salted_dedup_lets_through_the_same_keys_across_runs(spark, scratch):
    for run in range(2):
        hot = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string"))
        spark.range(0, 600, 1, 6).select(hot.alias("k"), "id").write.mode("append").parquet(f"{scratch}/in")
        landed = stream_table(spark, f"{scratch}/in", spark.read.parquet(f"{scratch}/in").schema)
        first = dedup.first_per_key(landed, ["k"], salts=4)
        run_available(append_stream(first, f"{scratch}/out", f"{scratch}/cp"))
        kept = [r.k for r in read_table(spark, f"{scratch}/out").select("k").collect()]
        assert len(kept) == len(set(kept)) == 201, run


def land(bank, root, condition):
    for entity in ENTITIES:
        key = silver.KEYS[entity]
        chosen = F.pmod(F.xxhash64(F.coalesce(F.col(key), F.lit("none"))), F.lit(3))
        bank.raw(entity).filter(condition(chosen)).write.mode("append").json(f"{root}/{entity}")


def test_triggered_refresh_in_steps_equals_one_batch(spark, sf_dir, scratch):
    bank = Bank(spark, sf_dir)
    counts = []
    for chosen in (lambda third: third == 0, lambda third: third > 0):
        land(bank, f"{scratch}/landing", chosen)
        counts.append(
            refresh.refresh_available(
                spark,
                f"{scratch}/landing",
                f"{scratch}/stream",
                f"{scratch}/cp",
                EXTRA_FIELDS,
                maxFilesPerTrigger=4,
            )
        )
    # nothing new landed, so nothing new is counted and the tables stay as they are
    idle = refresh.refresh_available(spark, f"{scratch}/landing", f"{scratch}/stream", f"{scratch}/cp", EXTRA_FIELDS)
    assert sum(table.get("rows", 0) for layer in idle.values() for table in layer.values()) == 0

    batch_counts = refresh.refresh_batch(spark, f"{scratch}/landing", f"{scratch}/batch", EXTRA_FIELDS)
    for table, dropped in {
        "silver/customers": INGESTED_AT, "silver/accounts": INGESTED_AT, "silver/transactions": INGESTED_AT,
        "gold/customer_360": UPDATED_AT, "gold/fraud_alerts": UPDATED_AT,
    }.items():
        streamed, batch = (read_table(spark, f"{scratch}/{kind}/{table}").drop(dropped) for kind in ("stream", "batch"))
        assert same(streamed, batch), table

    current = read_current(spark, refresh.CUSTOMER_CHANGES, f"{scratch}/stream/silver/customers_cdc")
    feed = read_table(spark, f"{scratch}/stream/bronze/customers")
    assert same(current, apply_changes(feed, refresh.CUSTOMER_CHANGES))
    assert "_source_file" not in current.columns and current.filter("is_deleted").count() == 0

    # the counts of both runs together are those of the whole input
    for entity in ENTITIES:
        rules_of = {"bronze": (rulebook.BRONZE, bank.landed), "silver": (rulebook.SILVER, bank.cleaned)}
        for layer, (book, source) in rules_of.items():
            whole = source(entity).withColumn("_malformed", F.lit(None).cast("string"))
            rules = book[entity] + (rulebook.LANDED[entity] if layer == "bronze" else ())
            want = {"rows": whole.count()} | {
                r.name: whole.filter(f"NOT coalesce({r.predicate}, false)").count() for r in rules
            }
            got = {name: sum(c[layer][entity].get(name, 0) for c in counts) for name in want}
            assert got == want == batch_counts[layer][entity], (layer, entity)


def test_a_failing_stream_stops_the_others_and_shows(spark, scratch):
    spark.range(10).write.parquet(f"{scratch}/in")
    landed = stream_table(spark, f"{scratch}/in", spark.range(1).schema)
    broken = landed.select(F.raise_error(F.lit("broken on purpose")).cast("string").alias("v"))
    writers = {
        "broken": append_stream(broken, f"{scratch}/broken", f"{scratch}/cp_broken"),
        "sound": append_stream(landed, f"{scratch}/sound", f"{scratch}/cp_sound"),
    }
    with pytest.raises(StreamingQueryException, match="broken on purpose"):
        run_together(writers)
    assert not spark.streams.active
    run_available(append_stream(landed, f"{scratch}/sound", f"{scratch}/cp_sound"))
    assert read_table(spark, f"{scratch}/sound").count() == 10


def test_stored_bronze_has_the_declared_layout(spark, sf_dir, scratch):
    bank = Bank(spark, sf_dir)
    bank.raw("transactions").write.json(f"{scratch}/landing")
    landed = stream_landing(spark, f"{scratch}/landing", RAW["transactions"], maxFilesPerTrigger=1)
    assert landed.isStreaming
    run_available(append_stream(landed, f"{scratch}/out", f"{scratch}/cp"))
    stored = [(f.name, f.dataType) for f in read_table(spark, f"{scratch}/out").schema.fields]
    assert stored == [(f.name, f.dataType) for f in bronze_schema("transactions").fields]
