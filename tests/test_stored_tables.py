"""Tables that streams fill batch by batch: first arrivals, buckets, forgetting, versions, views and counts."""

import os
import threading

import pytest
from pyspark.sql import functions as F
from test_refresh import CUSTOMER, land, land_all

from vaultline.operators import privacy
from vaultline.operators.changes import ChangeFeed
from vaultline.plans import refresh
from vaultline.sinks import overwrite, replace_partitions, settle, switch_table, table_tags
from vaultline.sources.tables import read_table, stream_table
from vaultline.streaming.batches import fold_ledger, write_first
from vaultline.streaming.changes import compact, read_current, write_changes
from vaultline.streaming.run import run_available

# --- first arrivals ---------------------------------------------------------------------------


def test_the_file_written_first_wins_within_one_trigger(spark, scratch):
    """The later file is the larger one and its name sorts first."""
    landing = f"{scratch}/landing"
    land_all(landing)
    land(f"{landing}/customers", "z_first.json", [{**CUSTOMER, "customer_id": "9", "full_name": "first"}], 1_700_000_000)
    later = [{**CUSTOMER, "customer_id": str(i), "full_name": "later"} for i in range(9, 400)]
    land(f"{landing}/customers", "a_later.json", later, 1_700_000_100)
    refresh.refresh_available(spark, landing, f"{scratch}/stream", f"{scratch}/checkpoints", buckets=4)
    refresh.refresh_batch(spark, landing, f"{scratch}/batch", buckets=4)
    for out in ("stream", "batch"):
        names = {r["customer_id"]: r["full_name"] for r in read_table(spark, f"{scratch}/{out}/silver/customers").collect()}
        assert names["9"] == "FIRST" and names["10"] == "LATER" and len(names) == 392


def first_run(spark, scratch, schema="k string, v int, at int"):
    landed = stream_table(spark, f"{scratch}/in", spark.createDataFrame([], schema).schema)
    writer = write_first(landed, f"{scratch}/out", f"{scratch}/cp", ["k"], f"{scratch}/known",
                         lambda fresh, _: fresh.where("v is null or v >= 0"), arrival=["at"])
    run_available(writer)
    return sorted(((r.k or "", r.v) for r in read_table(spark, f"{scratch}/out", landed.schema).collect()), key=str)


def arrive(spark, scratch, rows, partitions=3):
    frame = spark.createDataFrame(rows, "k string, v int, at int").repartition(partitions)
    frame.write.mode("append").parquet(f"{scratch}/in")


def test_an_earlier_batch_wins_and_what_a_rule_drops_stays_known(spark, scratch):
    arrive(spark, scratch, [("a", 1, 5), ("a", 2, 4), ("b", -1, 1), ("b", 7, 2), (None, 3, 2), (None, 4, 1)])
    assert first_run(spark, scratch) == [("", 4), ("a", 2)]
    arrive(spark, scratch, [("a", 9, 0), ("b", 8, 0), (None, 9, 0), ("c", 6, 9), ("c", 5, 8)])
    assert first_run(spark, scratch) == [("", 4), ("a", 2), ("c", 5)]


def test_a_batch_that_is_run_again_keeps_the_same_rows_also_after_folding(spark, scratch):
    expected = []
    for number in range(3):
        arrive(spark, scratch, [(f"k{number}", number, 0), (f"k{number}", 50, 1), ("k0", 99, -1)])
        expected.append((f"k{number}", number if number else 99))
        assert first_run(spark, scratch) == sorted(expected)
        # As after a driver that was lost before it noted that the batch is done.
        for name in (str(number), f".{number}.crc"):
            os.remove(f"{scratch}/cp/commits/{name}")
        assert first_run(spark, scratch) == sorted(expected)
        assert fold_ledger(spark, f"{scratch}/known") == (1 if number else 0)
    assert first_run(spark, scratch) == sorted(expected)
    assert sorted(p for p in os.listdir(f"{scratch}/known") if "batch" in p) == ["batch=-1", "batch=2"]
    assert fold_ledger(spark, f"{scratch}/known") == 0


def test_hot_and_missing_keys(spark, scratch):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").alias("k"), F.col("id").cast("int").alias("v"), F.lit(1).alias("at"))
    rows.withColumn("at", F.col("v")).repartition(5).write.parquet(f"{scratch}/in")
    assert first_run(spark, scratch) == [("", 0), ("hot", 1)]


def test_tables_of_earlier_versions_are_refused(spark, scratch):
    os.makedirs(f"{scratch}/known/_spark_metadata")
    arrive(spark, scratch, [("a", 1, 1)])
    with pytest.raises(ValueError, match="earlier version"):
        first_run(spark, scratch)


# --- partitions and buckets ---------------------------------------------------------------------


def times(root):
    return {
        f"{folder}/{name}": os.stat(f"{folder}/{name}").st_mtime_ns
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    }


def test_only_the_partitions_of_the_rows_are_replaced(spark, scratch):
    overwrite(spark.range(40).withColumn("p", F.col("id") % 4), f"{scratch}/t", ["p"])
    before = times(f"{scratch}/t")
    replace_partitions(spark.createDataFrame([(100, 2)], "id long, p long"), f"{scratch}/t", "p")
    after = times(f"{scratch}/t")
    assert {p for p in before.items() if "p=2" not in p[0]} <= set(after.items())
    rows = spark.read.parquet(f"{scratch}/t")
    assert [r.id for r in rows.where("p = 2").collect()] == [100] and rows.count() == 31


def test_a_replacement_that_broke_off_is_finished_or_dropped(spark, scratch):
    overwrite(spark.range(40).withColumn("p", F.col("id") % 4), f"{scratch}/t", ["p"])
    # Broken off while it was written: dropped.
    spark.range(1).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(f"{scratch}/t/_coming")
    assert settle(spark, f"{scratch}/t") == [] and read_table(spark, f"{scratch}/t").count() == 40
    # Broken off while its folders were moved, one of them just removed: finished.
    spark.range(2).withColumn("p", F.col("id")).write.partitionBy("p").parquet(f"{scratch}/t/_coming")
    open(f"{scratch}/t/_coming/_whole", "w").close()
    os.rename(f"{scratch}/t/p=0", f"{scratch}/elsewhere")
    assert len(settle(spark, f"{scratch}/t")) == 2
    assert read_table(spark, f"{scratch}/t").count() == 22
    assert sorted(os.listdir(f"{scratch}/t")) == sorted(x for x in os.listdir(f"{scratch}/t") if not x.startswith("_coming"))


FEED = ChangeFeed(keys=("k",), sequence=("seq",), delete_when="gone = true")


def change(spark, scratch, number, rows):
    spark.createDataFrame(rows, "k string, seq int, gone boolean").write.parquet(f"{scratch}/in/{number}")
    landed = stream_table(spark, f"{scratch}/in/*", spark.createDataFrame([], "k string, seq int, gone boolean").schema)
    run_available(write_changes(landed, FEED, f"{scratch}/t", f"{scratch}/cp"))


def test_a_change_of_one_key_rewrites_one_bucket(spark, scratch):
    change(spark, scratch, 0, [(f"k{i}", 1, False) for i in range(100)])
    assert compact(spark, FEED, f"{scratch}/t", buckets=8) == 0
    before = times(f"{scratch}/t/base")
    assert len({os.path.dirname(p) for p in before}) == 9  # with the empty base
    change(spark, scratch, 1, [("k7", 2, True)])
    assert compact(spark, FEED, f"{scratch}/t", buckets=8) == 1
    after = times(f"{scratch}/t/base")
    assert len({os.path.dirname(p) for p in set(before.items()) ^ set(after.items()) for p in p[:1]}) == 1
    assert read_current(spark, FEED, f"{scratch}/t").count() == 99


def test_folding_that_broke_off_before_the_changes_went_gives_the_same_rows(spark, scratch):
    change(spark, scratch, 0, [("a", 1, False), ("b", 1, False)])
    change(spark, scratch, 1, [("a", 2, True), ("c", 1, False)])
    kept = f"{scratch}/kept"
    spark.read.parquet(f"{scratch}/t/changes/batch=1").write.parquet(kept)
    compact(spark, FEED, f"{scratch}/t", buckets=2)
    spark.read.parquet(kept).write.parquet(f"{scratch}/t/changes/batch=1")
    for _ in range(2):
        assert sorted(r.k for r in read_current(spark, FEED, f"{scratch}/t").collect()) == ["b", "c"]
        assert compact(spark, FEED, f"{scratch}/t", buckets=2) == 1


# --- the right to be forgotten -------------------------------------------------------------------


def test_forgetting_rewrites_what_holds_an_identity_and_nothing_else(spark, scratch):
    landing, out = f"{scratch}/landing", f"{scratch}/out"
    land_all(landing)
    people = [{**CUSTOMER, "customer_id": str(i), "full_name": f"name {i}", "is_deleted": i == 5} for i in range(2, 60)]
    land(f"{landing}/customers", "people.json", people, 1_700_000_000)
    options = {"buckets": 8}
    refresh.refresh_available(spark, landing, out, f"{scratch}/cp", **options)
    left = {**CUSTOMER, "customer_id": "6", "full_name": "name 6", "is_deleted": True, "created_at": "2024-05-01T00:00:00"}
    land(f"{landing}/customers", "left.json", [left], 1_700_000_100)
    refresh.refresh_available(spark, landing, out, f"{scratch}/cp", **options)

    before = times(f"{out}/bronze") | times(f"{out}/silver/customers")
    rewritten = refresh.forget_customers(spark, out)
    after = times(f"{out}/bronze") | times(f"{out}/silver/customers")
    assert 0 < len(rewritten["silver"]) <= 2 and 0 < len(rewritten["bronze"]) <= 3
    untouched = {p: t for p, t in before.items() if os.path.dirname(p) not in {f for v in rewritten.values() for f in v}}
    assert untouched.items() <= after.items() and len(untouched) > 10

    for folder, rows in (("bronze/customers", 3), ("silver/customers", 2), ("gold/customer_360", 2)):
        stored = read_table(spark, f"{out}/{folder}")
        gone = stored.where("customer_id in ('5', '6')").select("full_name", "email").distinct().collect()
        assert {tuple(r) for r in gone} == {("ANONYMIZED", f"deleted_{i}@anonymized.com") for i in (5, 6)}, folder
        assert stored.where("full_name = 'ANONYMIZED'").count() == rows
    assert refresh.forget_customers(spark, out) == {"bronze": [], "silver": []}

    # The streams behind read the rewritten folders once more, and nothing changes.
    counts = refresh.refresh_available(spark, landing, out, f"{scratch}/cp", **options)
    assert counts["silver"]["customers"].get("rows", 0) == 0
    assert read_table(spark, f"{out}/silver/customers").count() == 59
    assert refresh.current_customers(spark, out).count() == 57


def test_forgetting_in_tables_of_a_batch_run(spark, scratch):
    land_all(f"{scratch}/landing")
    gone = {**CUSTOMER, "customer_id": "2", "is_deleted": True}
    land(f"{scratch}/landing/customers", "gone.json", [gone], 1_700_000_000)
    refresh.refresh_batch(spark, f"{scratch}/landing", f"{scratch}/out", buckets=4)
    rewritten = refresh.forget_customers(spark, f"{scratch}/out")
    assert [len(v) for v in rewritten.values()] == [1, 1]
    names = {r.customer_id: r.full_name for r in read_table(spark, f"{scratch}/out/gold/customer_360").collect()}
    assert names == {"1": "JO", "2": "ANONYMIZED"}


# --- versions, views, counts ---------------------------------------------------------------------


@pytest.fixture
def database(spark, scratch):
    name = "stored_" + scratch.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_reader_never_fails_while_a_table_is_switched(spark, scratch, database):
    table = f"{database}.numbers"
    seen, failed, done = set(), [], threading.Event()
    switch_table(spark.range(100), table, f"{scratch}/numbers", "Numbers", {"quality": "gold"})

    def read():
        while not done.is_set():
            try:
                seen.add(spark.table(table).count())
            except Exception as error:
                failed.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 11):
        switch_table(spark.range(100 + n), table, f"{scratch}/numbers", "Numbers", {"quality": "gold"})
    done.set()
    reader.join()
    assert not failed and seen <= set(range(100, 111)) and spark.table(table).count() == 110
    assert len(os.listdir(f"{scratch}/numbers")) == 3
    assert table_tags(spark, table)["quality"] == "gold"


def test_a_switched_table_takes_new_columns_and_keeps_the_old(spark, scratch, database):
    table = f"{database}.t"
    switch_table(spark.range(2), table, scratch, "T", {})
    switch_table(spark.range(3).select(F.lit("x").alias("v"), "id"), table, scratch, "T", {})
    assert sorted(map(tuple, spark.table(table).collect())) == [(0, "x"), (1, "x"), (2, "x")]
    with pytest.raises(ValueError, match="lose or change"):
        switch_table(spark.range(3).select(F.lit("x").alias("v")), table, scratch, "T", {})
    with pytest.raises(Exception, match="no luck"):
        broken = spark.range(3).select("id", F.expr("if(id > 1, raise_error('no luck'), 'y')").alias("v"))
        switch_table(broken, table, scratch, "T", {})
    assert spark.table(table).count() == 3
    assert switch_table(spark.range(1).select("id", F.lit("z").alias("v")), table, scratch, "T", {}) > 3
    assert [tuple(r) for r in spark.table(table).collect()] == [(0, "z")]


def test_gold_tables_of_the_catalog_are_switched(spark, scratch, database):
    land_all(f"{scratch}/landing")
    for _ in range(2):
        refresh.refresh_available(
            spark, f"{scratch}/landing", f"{scratch}/out", f"{scratch}/cp", buckets=2, database=database
        )
    assert spark.table(f"{database}.customer_360").count() == 1 == spark.table(f"{database}.fraud_alerts").count()
    refresh.register_tables(spark, f"{scratch}/out", database)
    assert table_tags(spark, f"{database}.customer_360")["quality"] == "gold"


def test_the_change_table_has_its_name_before_the_first_change(spark, scratch, database):
    out = f"{scratch}/out"
    refresh.register_tables(spark, out, database)
    view = f"{database}.customers_cdc"
    assert spark.table(view).count() == 0
    assert {"quality": "silver", "pii": "true"}.items() <= table_tags(spark, view).items()
    land_all(f"{scratch}/landing")
    refresh.refresh_available(spark, f"{scratch}/landing", out, f"{scratch}/cp", buckets=2)
    assert [r.full_name for r in spark.table(view).collect()] == ["Jo"]
    assert "_source_file" not in spark.table(view).columns
    refresh.compact_customers(spark, out)
    newer = {**CUSTOMER, "full_name": "Jo B", "created_at": "2024-02-01T00:00:00"}
    land(f"{scratch}/landing/customers", "newer.json", [newer], 1_700_000_100)
    refresh.refresh_available(spark, f"{scratch}/landing", out, f"{scratch}/cp", buckets=2)
    assert [r.full_name for r in spark.table(view).collect()] == ["Jo B"]


def test_one_secured_view_shows_each_user_their_rows(spark, scratch, database):
    people = [("1", "a@x.y", "+33612345678", "FR"), ("2", "b@x.y", "+33612345678", "BE"), ("3", "c@x.y", "+33612345678", None)]
    spark.createDataFrame(people, "customer_id string, email string, phone string, nationality string").write.saveAsTable(f"{database}.customers")
    members = [("ann", "data-analysts-fr"), ("bob", "data-analysts-be"), ("bob", "data-analysts-fr"), ("eve", "data-engineers")]
    spark.createDataFrame(members, "user_name string, group_name string").write.saveAsTable(f"{database}.members")
    views = privacy.secure_in_catalog(
        spark, {"customers": f"{database}.customers"}, f"{database}.members", {"customers": privacy.POLICIES["customers"]}
    )
    user = spark._jvm.org.apache.spark.sql.catalyst.CurrentUserContext.CURRENT_USER()

    def seen(name):
        user.set(name)
        try:
            return sorted((r.customer_id, r.email) for r in spark.sql(f"SELECT * FROM {views['customers']}").collect())
        finally:
            user.remove()

    assert seen("ann") == seen("bob") == [("1", "a***@x.y")]
    assert seen("eve") == [("1", "a@x.y"), ("2", "b@x.y"), ("3", "c@x.y")]
    assert seen("nobody") == []
    spark.sql(f"INSERT INTO {database}.members VALUES ('nobody', 'data-analysts-be')")
    assert seen("nobody") == [("2", "b***@x.y")]
    with pytest.raises(ValueError, match="unknown columns"):
        privacy.secured_query("t", ["email"], privacy.POLICIES["customers"], "m")


def test_stored_counts_grow_by_batches_and_not_by_replays(spark, scratch):
    out, cp = f"{scratch}/out", f"{scratch}/cp"
    assert refresh.rule_counts(spark, out).count() == 0
    land_all(f"{scratch}/landing")
    refresh.refresh_available(spark, f"{scratch}/landing", out, cp, buckets=2)
    once = sorted(map(tuple, refresh.rule_counts(spark, out).collect()))
    assert ("silver_customers", 0, "valid kyc_status", 1, 0) in once
    for layer, entity in (("silver", "customers"), ("bronze", "accounts")):
        for name in ("0", ".0.crc"):
            os.remove(f"{cp}/{layer}/{entity}/commits/{name}")
    refresh.refresh_available(spark, f"{scratch}/landing", out, cp, buckets=2)
    assert sorted(map(tuple, refresh.rule_counts(spark, out).collect())) == once
    land(f"{scratch}/landing/customers", "odd.json", [{**CUSTOMER, "customer_id": "3", "kyc_status": "odd"}], 1_700_000_100)
    refresh.refresh_available(spark, f"{scratch}/landing", out, cp, buckets=2)
    assert ("silver_customers", 1, "valid kyc_status", 1, 1) in set(map(tuple, refresh.rule_counts(spark, out).collect()))


# --- fields found on the way, archived files, layouts, kept totals ---------------------------------


def test_a_field_that_lands_later_is_kept_from_then_on(spark, scratch, database):
    landing, out, cp = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/cp"
    options = {"buckets": 4, "found_fields": True}
    land_all(landing)
    refresh.refresh_available(spark, landing, out, cp, **options)
    land(f"{landing}/customers", "vip.json", [{**CUSTOMER, "customer_id": "2", "vip": True, "tier": 3}], 1_700_000_100)
    refresh.refresh_available(spark, landing, out, cp, **options)
    odd = [{**CUSTOMER, "customer_id": "3", "vip": "maybe"}, {**CUSTOMER, "customer_id": "4", "is_deleted": True}]
    land(f"{landing}/customers", "odd.json", odd, 1_700_000_200)
    refresh.refresh_available(spark, landing, out, cp, **options)

    extras = refresh.stored_extras(spark, out)
    assert {f.name: f.dataType.simpleString() for f in extras["customers"]} == {"tier": "bigint", "vip": "boolean"}
    silver = read_table(spark, f"{out}/silver/customers", refresh._silver_schema(spark, "customers", extras))
    assert {r.customer_id: (r.vip, r.tier) for r in silver.collect()} == {
        "1": (None, None), "2": (True, 3), "3": (None, None), "4": (None, None),
    }
    torn = read_table(spark, f"{out}/bronze/customers", refresh.bronze_schema("customers", *extras["customers"]))
    assert [r["_malformed"] for r in torn.where("customer_id = '3'").collect()] == [__import__("json").dumps(odd[0])]
    for _ in range(2):  # also once the change table is folded into buckets of different age
        assert {r.customer_id: r.vip for r in refresh.current_customers(spark, out).collect()} == {"1": None, "2": True, "3": None}
        refresh.compact_customers(spark, out)
    refresh.forget_customers(spark, out)
    again = read_table(spark, f"{out}/silver/customers", silver.schema)
    assert {r.customer_id: (r.vip, r.full_name) for r in again.collect()}["2"] == (True, "JO")
    assert again.where("customer_id = '4'").first().full_name == "ANONYMIZED"
    refresh.register_tables(spark, out, database)
    assert {r.customer_id: r.vip for r in spark.table(f"{database}.customers_cdc").collect()} == {"1": None, "2": True, "3": None}


def test_only_new_files_are_looked_at_for_fields(spark, scratch):
    from vaultline.schemas import RAW
    from vaultline.sources.fields import kept_fields, note_fields

    landing, log = f"{scratch}/landing", f"{scratch}/log"
    land(landing, "a.json", [{**CUSTOMER, "x": 1}], 1_700_000_000)
    assert [f.name for f in note_fields(spark, landing, RAW["customers"], log)] == ["x"]
    land(landing, "a.json", [{**CUSTOMER, "not looked at": 1}], 1_700_000_000)
    land(landing, "b.json", [{**CUSTOMER, "y": 1, "x": "text"}], 1_700_000_000)
    found = note_fields(spark, landing, RAW["customers"], log)
    assert [(f.name, f.dataType.simpleString()) for f in found] == [("x", "bigint"), ("y", "bigint")]
    assert note_fields(spark, landing, RAW["customers"], log) == found == kept_fields(spark, log)


def test_landed_files_leave_for_the_archive_and_are_read_once(spark, scratch):
    landing, out, cp, archive = (f"{scratch}/{n}" for n in ("landing", "out", "cp", "archive"))
    land_all(landing)
    for n in range(3):
        refresh.refresh_available(spark, landing, out, cp, buckets=2, archive=archive)
        land(f"{landing}/customers", f"more_{n}.json", [{**CUSTOMER, "customer_id": f"m{n}"}], 1_700_000_100 + n)
    refresh.refresh_available(spark, landing, out, cp, buckets=2, archive=archive)
    left = [x for x in os.listdir(f"{landing}/customers") if x.endswith(".json")]
    moved = [x for _, _, names in os.walk(f"{archive}/customers") for x in names if x.endswith(".json")]
    assert "one.json" not in left and "one.json" in moved and len(left) + len(moved) == 4
    assert read_table(spark, f"{out}/silver/customers").count() == 4
    assert read_table(spark, f"{out}/bronze/customers").count() == 4


def test_interleaved_files_are_narrow_in_both_columns(spark, scratch):
    from vaultline.sinks import write_interleaved

    rows = spark.range(6400).select((F.col("id") * 37 % 6400).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 61 % 6400).cast("string"), 4, "0")).alias("b"))
    rows = rows.unionByName(spark.createDataFrame([(None, None)], "a long, b string"))
    write_interleaved(rows.repartition(7), f"{scratch}/z", "a", "b", partitions=16)
    stored = spark.read.parquet(f"{scratch}/z")
    assert stored.count() == 6401
    number = F.substring("b", 2, 4).cast("int")
    spans = stored.groupBy("_metadata.file_path").agg(
        (F.max("a") - F.min("a")).alias("a"), (F.max(number) - F.min(number)).alias("b")
    ).collect()
    assert len(spans) == 16
    for column in ("a", "b"):
        assert sum(s[column] for s in spans) / 16 < 6400 * 0.5, column  # unordered files span nearly all
    assert max(min(s.a, s.b) for s in spans) < 6400 * 0.55


def test_kept_totals_are_those_of_all_transactions(spark, scratch, sf_dir):
    from vaultline.operators.rollups import tx_metrics
    from vaultline.operators.velocity import fraud_by_account
    from vaultline.streaming.totals import add_batch, start_totals, stored_fraud_by_account, stored_tx_metrics
    from vaultline.workload.adapter import Bank

    moves = Bank(spark, sf_dir).silver("transactions")
    hot = F.when(F.xxhash64("transaction_id") % 3 == 0, "hot").otherwise(F.col("account_id"))
    odd = F.when(F.xxhash64("transaction_id") % 50 == 1, F.lit(float("inf"))).otherwise(F.col("amount"))
    week = F.expr("transaction_date + make_interval(0, 0, cast(pmod(xxhash64(transaction_id), 3) as int) * 1)")
    moves = moves.withColumns({"account_id": hot, "amount": odd, "transaction_date": week})
    moves = moves.withColumn("account_id", F.when(F.col("transaction_type") != "click", F.col("account_id")))
    moves.write.parquet(f"{scratch}/moves")
    moves = spark.read.parquet(f"{scratch}/moves")
    root = f"{scratch}/totals"
    start_totals(spark, root)
    assert stored_tx_metrics(spark, root).count() == 0
    part = F.pmod(F.xxhash64("transaction_id", "channel"), F.lit(4))
    for number, chosen in enumerate((2, 0, 3, 1)):
        for _ in range(2):  # a batch that is run again
            add_batch(moves.where(part == chosen), number, root)
        if number == 1:
            before = times(f"{root}/totals")
    add_batch(moves.limit(0), 4, root)
    assert before and not set(before) <= set(times(f"{root}/totals"))
    for got, want in ((stored_fraud_by_account(spark, root), fraud_by_account(moves)), (stored_tx_metrics(spark, root), tx_metrics(moves))):
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_a_batch_of_one_week_leaves_the_other_weeks_alone(spark, scratch):
    from vaultline.streaming.totals import add_batch, start_totals

    def moves(days):
        rows = [(f"t{d}-{i}", f"a{i}", 1.0, False, f"2024-{d}") for d in days for i in range(5)]
        frame = spark.createDataFrame(rows, "transaction_id string, account_id string, amount double, is_flagged_fraud boolean, d string")
        return frame.withColumn("transaction_date", F.to_timestamp("d", "yyyy-D")).drop("d")

    root = f"{scratch}/totals"
    start_totals(spark, root)
    add_batch(moves([5, 40, 80]), 0, root)
    before = times(f"{root}/totals")
    add_batch(moves([41]), 1, root)
    after = times(f"{root}/totals")
    assert len(before) == 3 == len(after) and len(set(before.items()) & set(after.items())) == 2
