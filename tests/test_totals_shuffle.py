"""Account totals deal out their rows once."""

import datetime as dt

from conftest import plan_of
from pyspark.sql import functions as F

from vaultline.streaming.totals import by_second, by_slot

START = dt.datetime(2024, 1, 6)


def test_totals_add_up_the_seconds_of_all_batches_in_one_shuffle(spark, scratch, static_plans):
    moves = [(str(i), "hot" if i % 3 else None, START + dt.timedelta(hours=i % 60), 1.25, i % 7 == 0) for i in range(300)]
    moves += [("x", "hot", None, 2.0, True), ("y", "hot", None, None, False)]
    schema = "transaction_id string, account_id string, transaction_date timestamp, amount double, is_flagged_fraud boolean"
    moves = spark.createDataFrame(moves, schema)
    parts = [by_second(moves.where(F.pmod(F.xxhash64("transaction_id"), F.lit(3)) == k)) for k in range(3)]
    parts[0].unionByName(parts[1]).unionByName(parts[2]).write.parquet(f"{scratch}/parts")
    by_second(moves).write.parquet(f"{scratch}/whole")
    in_parts, whole = (by_slot(spark.read.parquet(f"{scratch}/{name}")) for name in ("parts", "whole"))
    assert sorted(map(str, in_parts.collect())) == sorted(map(str, whole.select(in_parts.columns).collect()))
    assert whole.agg(F.sum("ids")).first()[0] == 302
    assert plan_of(in_parts).count("Exchange hashpartitioning") == 1
