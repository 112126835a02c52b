import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from vaultline import session, sinks
from vaultline.plans.customer_360 import CLUSTER_COLUMNS
from vaultline.schemas import INGESTED_AT, MALFORMED, RAW, SOURCE_FILE, SOURCE_TIME
from vaultline.sources import generator, landing
from vaultline.streaming.run import run_available


YEAR = (dt.datetime(2024, 1, 1), dt.datetime(2024, 12, 31))


def land(spark, path, n=20):
    sinks.write_json(generator.accounts(generator.row_numbers(spark, n), *YEAR), path)


def test_landed_rows_carry_file_and_time(spark, scratch):
    land(spark, scratch)
    landed = landing.read_landing(spark, scratch, RAW["accounts"])
    assert landed.columns == [*RAW["accounts"].names, MALFORMED, INGESTED_AT, SOURCE_FILE, SOURCE_TIME]
    row = landed.agg(F.count("*"), F.count(INGESTED_AT), F.count_if(F.col(SOURCE_FILE).contains(scratch))).first()
    assert tuple(row) == (20, 20, 20)


def test_one_array_per_file_needs_multi_line(spark, tmp_path):
    records = [{"account_id": str(i), "balance": i / 4} for i in range(3)]
    (tmp_path / "accounts.json").write_text(json.dumps(records, indent=2), encoding="utf-8")
    whole = landing.read_landing(spark, str(tmp_path), RAW["accounts"], multi_line=True)
    assert sorted((r.account_id, r.balance) for r in whole.collect()) == [("0", 0.0), ("1", 0.25), ("2", 0.5)]
    by_line = landing.read_landing(spark, str(tmp_path), RAW["accounts"])
    assert by_line.filter("account_id IS NOT NULL").count() == 0


def test_json_lines_keep_every_value(spark, scratch):
    made = generator.transactions(generator.row_numbers(spark, 300), 10)
    sinks.write_json(made, scratch)
    back = landing.read_landing(spark, scratch, RAW["transactions"]).drop(MALFORMED, INGESTED_AT, SOURCE_FILE, SOURCE_TIME)
    assert back.exceptAll(made).count() == 0 == made.exceptAll(back).count()


def test_inferred_types(spark, scratch):
    land(spark, scratch)
    found = {f.name: f.dataType.simpleString() for f in landing.infer_schema(spark, scratch).fields}
    assert found == {f.name: f.dataType.simpleString() for f in RAW["accounts"].fields}


def test_a_stream_can_use_the_inferred_types(spark, scratch):
    land(spark, f"{scratch}/landing")
    found = landing.infer_schema(spark, f"{scratch}/landing")
    stream = landing.stream_landing(spark, f"{scratch}/landing", found)
    run_available(sinks.append_stream(stream, f"{scratch}/out", f"{scratch}/checkpoint"))
    stored = spark.read.parquet(f"{scratch}/out").select(*RAW["accounts"].names)
    assert stored.exceptAll(generator.accounts(generator.row_numbers(spark, 20), *YEAR)).count() == 0
    assert stored.count() == 20


def test_landing_path_follows_the_configured_catalog(spark):
    assert landing.landing_path(spark, "customers") == "/data/bank_dev/raw_data/landing/customers/"
    spark.conf.set("catalog_name", "bank_prod")
    try:
        assert landing.landing_path(spark, "accounts", "/mnt") == "/mnt/bank_prod/raw_data/landing/accounts/"
    finally:
        spark.conf.unset("catalog_name")


def test_clustered_files_have_separate_key_ranges(spark, scratch):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), "id").repartition(5)
    sinks.write_clustered(rows, scratch, "k", partitions=4)
    stored = spark.read.parquet(scratch)
    ranges = sorted(
        (r.low, r.high)
        for r in stored.groupBy("_metadata.file_path").agg(F.min("k").alias("low"), F.max("k").alias("high")).collect()
    )
    assert stored.count() == 1000 and len(ranges) == 4
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_tables_keep_their_comment_and_tags(spark, scratch):
    tags = {"quality": "silver", "pii": "true", "owner's note": "it's \\ fine"}
    sinks.create_tagged(spark.range(3), "tagged_numbers", scratch, "Three 'numbers'", tags)
    try:
        assert tags.items() <= sinks.table_tags(spark, "tagged_numbers").items()
        described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED tagged_numbers").collect()}
        assert described["Comment"] == "Three 'numbers'"
        assert spark.table("tagged_numbers").count() == 3
    finally:
        spark.sql("DROP TABLE tagged_numbers")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("_tagged_")]


class FakeContext:
    applicationId = "app-scratch-test"

    def __init__(self, master):
        self.master = master


class FakeSession:
    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured}
        self.sparkContext = FakeContext(master)


def test_scratch_is_the_shared_folder_and_local_only_on_a_local_master():
    assert session.shared_root(FakeSession("hdfs://x/y/", "spark://h")) == "hdfs://x/y"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSession(None, "yarn"))
    local = session.shared_root(FakeSession(None, "local[2]"))
    assert os.path.isdir(local) and session.shared_root(FakeSession(None, "local[2]")) == local


def test_generated_moments_default_to_this_year(spark):
    made = generator.customers(generator.row_numbers(spark, 50)).agg(F.min("created_at")).first()[0]
    assert made >= f"{dt.datetime.now().year}-01-01"


def test_clustered_files_differ_in_their_scores(spark, scratch):
    scores = F.element_at(F.array(F.lit("high"), F.lit("low"), F.lit("medium")), (F.col("id") % 3 + 1).cast("int"))
    rows = spark.range(3000).select(F.col("id").alias("customer_id"), scores.alias("risk_score"))
    sinks.write_clustered(rows, scratch, *CLUSTER_COLUMNS, partitions=6)
    files = spark.read.parquet(scratch).groupBy("_metadata.file_path").agg(F.countDistinct("risk_score").alias("scores"))
    assert files.where("scores > 2").count() == 0 < files.where("scores = 1").count()
