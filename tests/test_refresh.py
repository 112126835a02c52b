import json
import os

import pytest
from pyspark.sql import functions as F

from vaultline import __main__ as job
from vaultline.operators import privacy
from vaultline.plans import refresh
from vaultline.sinks import overwrite, table_tags
from vaultline.sources.tables import read_table


def test_generated_files_to_named_gold_tables(spark, scratch, capsys):
    landing, out = f"{scratch}/landing", f"{scratch}/out"
    job.main(["generate", landing, "--customers", "60", "--transactions", "900"])
    job.main(["refresh", landing, out, "--checkpoints", f"{scratch}/checkpoints"])
    assert '"transaction_id not null": 0' in capsys.readouterr().out
    os.makedirs(f"{scratch}/catalogs/bank_test/raw_data")
    os.rename(landing, f"{scratch}/catalogs/bank_test/raw_data/landing")
    try:
        job.main(["refresh", f"{scratch}/catalogs", f"{scratch}/batch", "--catalog", "bank_test"])
    finally:
        spark.conf.unset("catalog_name")
    for table in ("customer_360", "fraud_alerts"):
        streamed, batch = (
            read_table(spark, f"{root}/gold/{table}").drop("_updated_at") for root in (out, f"{scratch}/batch")
        )
        assert streamed.count() > 0
        assert streamed.exceptAll(batch).count() == 0 == batch.exceptAll(streamed).count()
    assert refresh.current_customers(spark, out).count() == 60
    capsys.readouterr()
    job.main(["compact", out])
    assert capsys.readouterr().out.strip() == "0"
    assert refresh.current_customers(spark, out).count() == 60

    spark.sql("CREATE DATABASE IF NOT EXISTS refresh_test")
    try:
        refresh.register_tables(spark, out, "refresh_test")
        refresh.register_tables(spark, out, "refresh_test")
        assert spark.table("refresh_test.transactions").count() == 900
        for name, _, _, tags in refresh.TABLES:
            assert tags.items() <= table_tags(spark, f"refresh_test.{name}").items()
        customers = spark.table("refresh_test.customers")
        masked = privacy.secure_view(customers, privacy.TablePolicy({"email": privacy.masks.mask_email}))
        assert masked.filter("email RLIKE '^.[*]{3}@example'").count() == 60
    finally:
        spark.sql("DROP DATABASE refresh_test CASCADE")


def test_landing_defaults():
    chosen = job.arguments(["generate", "somewhere"])
    assert (chosen.customers, chosen.transactions) == (500, 5000)


CUSTOMER = {
    "customer_id": "1", "full_name": "Jo", "email": "jo@mail.test", "phone": "+33600000001",
    "kyc_status": "verified", "is_deleted": False, "created_at": "2024-01-01T00:00:00",
}
ACCOUNT = {
    "account_id": "a", "customer_id": "1", "account_type": "checking", "balance": 10.0, "currency": "EUR",
    "status": "active", "opened_at": "2024-01-01T00:00:00",
}
TRANSACTION = {
    "transaction_id": "t", "account_id": "a", "counterpart_iban": "FR761", "amount": 5.0, "currency": "EUR",
    "transaction_type": "transfer", "status": "completed", "is_flagged_fraud": False, "fraud_reason": None,
    "channel": "web", "transaction_date": "2024-01-02T00:00:00", "created_at": "2024-01-02T00:00:00",
}


def land(folder, name, rows, when, indent=None):
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{name}"
    with open(path, "w") as file:
        file.write(json.dumps(rows, indent=indent) if indent else "\n".join(map(json.dumps, rows)))
    os.utime(path, (when, when))


def land_all(landing, **options):
    for entity, row in (("customers", CUSTOMER), ("accounts", ACCOUNT), ("transactions", TRANSACTION)):
        land(f"{landing}/{entity}", "one.json", [row], 1_700_000_000, **options)


def test_files_with_one_array_reach_silver(spark, scratch):
    land_all(f"{scratch}/landing", indent=2)
    batch = refresh.refresh_batch(spark, f"{scratch}/landing", f"{scratch}/batch", multi_line=True)
    stream = refresh.refresh_available(
        spark, f"{scratch}/landing", f"{scratch}/stream", f"{scratch}/checkpoints", multi_line=True
    )
    for counts in (batch, stream):
        assert counts["bronze"]["transactions"]["well formed"] == 0
    for out in ("batch", "stream"):
        for entity in refresh.ENTITIES:
            assert read_table(spark, f"{scratch}/{out}/silver/{entity}").count() == 1


def test_malformed_lines_and_times_are_kept_and_counted(spark, scratch):
    land_all(f"{scratch}/landing")
    with open(f"{scratch}/landing/accounts/torn.json", "w") as file:
        file.write('{"account_id": "b", "bal\n' + json.dumps({**ACCOUNT, "account_id": "c", "opened_at": "soon"}))
    counts = refresh.refresh_batch(spark, f"{scratch}/landing", f"{scratch}/out")
    assert counts["bronze"]["accounts"] | {"rows": 3, "well formed": 1, "opened_at parsable": 1} == counts["bronze"]["accounts"]
    stored = read_table(spark, f"{scratch}/out/bronze/accounts").where("_malformed is not null").collect()
    assert [row["_malformed"] for row in stored] == ['{"account_id": "b", "bal']


def test_new_fields_are_kept_when_asked_for(spark, scratch):
    land_all(f"{scratch}/landing")
    land(f"{scratch}/landing/customers", "more.json", [{**CUSTOMER, "customer_id": "2", "vip": True}], 1_700_000_000)
    extras = refresh.found_extras(spark, f"{scratch}/landing")
    refresh.refresh_batch(spark, f"{scratch}/landing", f"{scratch}/out", extras)
    stored = {r["customer_id"]: r["vip"] for r in read_table(spark, f"{scratch}/out/bronze/customers").collect()}
    assert stored == {"1": None, "2": True}


def test_the_file_written_first_wins_in_batch_as_on_a_stream(spark, scratch):
    landing = f"{scratch}/landing"
    land_all(landing)
    land(f"{landing}/customers", "z_first.json", [{**CUSTOMER, "customer_id": "9"}], 1_700_000_000)
    options = (f"{scratch}/stream", f"{scratch}/checkpoints")
    refresh.refresh_available(spark, landing, *options)
    land(f"{landing}/customers", "a_later.json", [{**CUSTOMER, "customer_id": "9", "full_name": "later"}], 1_700_000_100)
    refresh.refresh_available(spark, landing, *options)
    refresh.refresh_batch(spark, landing, f"{scratch}/batch")
    for out in ("stream", "batch"):
        rows = read_table(spark, f"{scratch}/{out}/silver/customers").where("customer_id = '9'").collect()
        assert [r["full_name"] for r in rows] == ["JO"]


def test_entities_that_have_not_landed_give_empty_tables(spark, scratch):
    landing, out = f"{scratch}/landing", f"{scratch}/out"
    land(f"{landing}/customers", "one.json", [CUSTOMER], 1_700_000_000)
    for entity in ("accounts", "transactions"):
        os.makedirs(f"{landing}/{entity}")
    refresh.refresh_available(spark, landing, out, f"{scratch}/checkpoints")
    assert read_table(spark, f"{out}/gold/customer_360").count() == 1
    assert read_table(spark, f"{out}/gold/fraud_alerts").count() == 0
    assert refresh.current_customers(spark, out).count() == 1


def test_no_identity_of_a_deleted_customer_is_left(spark, scratch):
    landing, out = f"{scratch}/landing", f"{scratch}/out"
    land_all(landing)
    refresh.refresh_available(spark, landing, out, f"{scratch}/checkpoints")
    gone = {**CUSTOMER, "is_deleted": True, "created_at": "2024-03-01T00:00:00"}
    land(f"{landing}/customers", "gone.json", [gone], 1_700_000_100)
    refresh.refresh_available(spark, landing, out, f"{scratch}/checkpoints")
    assert refresh.compact_customers(spark, out) == 1
    assert refresh.current_customers(spark, out).count() == 0
    target = f"{out}/{refresh.CUSTOMERS_CDC}"
    assert [x for x in os.listdir(f"{target}/changes") if x.startswith("batch=")] == ["batch=-1"]
    kept = spark.read.parquet(f"{target}/base").select("full_name", "email", "phone").collect()
    assert [tuple(row) for row in kept] == [(None, None, None)]


def test_a_failing_plan_leaves_the_table_as_it_was(spark, scratch):
    overwrite(spark.range(3), f"{scratch}/t")
    with pytest.raises(Exception, match="no luck"):
        overwrite(spark.range(5).withColumn("id", F.expr("if(id > 3, raise_error('no luck'), id)")), f"{scratch}/t")
    assert read_table(spark, f"{scratch}/t").count() == 3
    overwrite(read_table(spark, f"{scratch}/t").union(spark.range(1)), f"{scratch}/t")
    assert read_table(spark, f"{scratch}/t").count() == 4
    assert sorted(os.listdir(scratch)) == ["t"]
