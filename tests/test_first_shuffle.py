"""First arrivals deal out their rows once."""

from conftest import plan_of
from pyspark.sql import functions as F

from vaultline.operators.dedup import leading_row
from vaultline.streaming.batches import start_table, unseen, write_batch


def test_unseen_rows_meet_the_known_keys_in_one_shuffle(spark, scratch, static_plans):
    rows = [(k, at, v) for v in range(40) for k, at in (("a", 1), ("b", v % 2), ("c", 3), (None, 2), (None, 3))]
    batch = spark.createDataFrame(rows, "k string, at int, v int").repartition(5)
    start_table(spark, f"{scratch}/known", batch.select("k").schema)
    order = [F.col("at").asc_nulls_first()]
    firsts = {tuple(r) for r in leading_row(batch, ["k"], order).collect()}
    assert {tuple(r) for r in unseen(batch, 0, ["k"], order, f"{scratch}/known").collect()} == firsts
    write_batch(spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "k string"), f"{scratch}/known", 0)
    write_batch(spark.createDataFrame([("b",)], "k string"), f"{scratch}/known", 2)  # a later batch does not count
    fresh = unseen(batch, 1, ["k"], order, f"{scratch}/known")
    assert fresh.columns == batch.columns
    assert {tuple(r) for r in fresh.collect()} == {r for r in firsts if r[0] in ("b", "c")}
    plan = plan_of(fresh)
    assert "Join" not in plan and plan.count("hashpartitioning(k") == 1
