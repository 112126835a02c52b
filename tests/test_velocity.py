import datetime as dt
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from vaultline.operators import velocity

SCHEMA = "transaction_id string, account_id string, transaction_date timestamp_ntz, is_flagged_fraud boolean"
DAY = 86_400


def at(seconds):
    return None if seconds is None else dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)


def frame(spark, moves):
    rows = [(t, a, at(s), f) for t, a, s, f in moves]
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(moves, span=DAY):
    """Ids of the same account within the span; rows without a date count among themselves."""
    counts = []
    for _, account, second, _ in moves:
        peers = [m for m in moves if m[1] == account]
        if second is None:
            near = [m for m in peers if m[2] is None]
        else:
            floor = second // 1
            near = [m for m in peers if m[2] is not None and floor - span <= m[2] // 1 <= floor]
        counts.append(sum(m[0] is not None for m in near))
    return counts


def test_window_edges(spark):
    moves = [(str(i), "a", s, False) for i, s in enumerate([0, DAY, DAY + 1, DAY + 1, None, None])]
    got = {r.transaction_id: r.tx_count_24h for r in velocity.velocity(frame(spark, moves)).collect()}
    assert [got[str(i)] for i in range(6)] == [1, 2, 3, 3, 2, 2]


def test_alert_needs_more_than_five(spark):
    moves = [(f"{a}{i}", a, i, False) for a, n in (("five", 5), ("six", 6)) for i in range(n)]
    rows = velocity.velocity(frame(spark, moves)).filter("velocity_alert").collect()
    assert [r.transaction_id for r in rows] == ["six5"]


def random_moves(seed, n=400):
    """Two ordinary accounts and a hot one; dates straddle the epoch, slot edges and whole weeks."""
    rng = random.Random(seed)
    moves = []
    for i in range(n):
        account = rng.choice(["hot", "hot", "hot", "a", "b", None])
        near_edge = rng.choice([-1, 0, 1]) * velocity.SLOT_SECONDS + rng.randrange(-2 * DAY, 2 * DAY)
        second = rng.choice([None, near_edge, near_edge + 0.5, rng.randrange(-20 * DAY, 20 * DAY)])
        moves.append((None if rng.random() < 0.05 else str(i), account, second, rng.choice([True, False, None])))
    return moves


@pytest.mark.parametrize("seed", range(4))
def test_counts_agree_with_brute_force(spark, seed):
    moves = random_moves(seed)
    got = velocity.velocity(frame(spark, moves)).collect()
    assert len(got) == len(moves)
    want = sorted((str(m[:3]), n) for m, n in zip([(t, a, at(s)) for t, a, s, _ in moves], brute_force(moves)))
    assert sorted((str((r.transaction_id, r.account_id, r.transaction_date)), r.tx_count_24h) for r in got) == want


@pytest.mark.parametrize("seed", range(2))
def test_account_totals_agree_with_brute_force(spark, seed):
    moves = random_moves(seed)
    want = {}
    for (_, account, second, fraud), n in zip(moves, brute_force(moves)):
        total = want.setdefault(account, [0, 0, None])
        total[0] += fraud is True
        total[1] += n > 5
        if second is not None and (total[2] is None or at(second) > total[2]):
            total[2] = at(second)
    got = velocity.fraud_by_account(frame(spark, moves)).collect()
    assert {r.account_id: [r.total_fraud_txns, r.velocity_alerts_count, r.last_fraud_date] for r in got} == want


@pytest.mark.parametrize(("span", "slot"), [(10, 10), (10, 11), (10, 1000), (0, 5)])
def test_any_slot_length_gives_the_same_counts(spark, span, slot):
    rng = random.Random(span * slot)
    moves = [(str(i), rng.choice("ab"), rng.randrange(-60, 60), False) for i in range(150)]
    counted = velocity.trailing_counts(velocity.per_second(frame(spark, moves)), span, slot).collect()
    got = {(r.account_id, r.second): r.tx_count_24h for r in counted}
    assert got == {(m[1], m[2]): n for m, n in zip(moves, brute_force(moves, span))}


def test_slots_may_not_be_shorter_than_the_span(spark):
    with pytest.raises(ValueError, match="slot"):
        velocity.trailing_counts(velocity.per_second(frame(spark, [])), 10, 9)


def test_no_task_gets_a_whole_account(spark, static_plans):
    plan = plan_of(velocity.fraud_by_account(frame(spark, random_moves(0))))
    assert "partial_count" in plan
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # per second, per slot, and last the finished totals per account
    assert len(shuffles) == 3
    assert "slot" in shuffles[1]


def test_many_rows_on_one_account_and_second(spark):
    hot = spark.range(20_000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.lit("hot").alias("account_id"),
        (F.lit(at(0)).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, 0, id % 3)")).alias("transaction_date"),
        F.lit(False).alias("is_flagged_fraud"),
    )
    counts = velocity.velocity(hot).groupBy("transaction_date").agg(F.max("tx_count_24h").alias("n"))
    assert sorted(r.n for r in counts.collect()) == [6667, 13334, 20000]


def test_adaptive_execution_splits_a_second_with_very_many_rows(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    hot = F.col("id") % 3 == 0
    moves = spark.range(0, 20_000, 1, 8).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.col("id").cast("string")).alias("account_id"),
        F.when(~hot, F.timestamp_seconds("id")).alias("transaction_date"),
    )
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counted = velocity.velocity(moves)
        assert {(r.account_id == "hot", r.tx_count_24h) for r in counted.collect()} == {(True, 6667), (False, 1)}
        assert "SortMergeJoin(skew=true)" in plan_of(counted)
    finally:
        for key in settings:
            spark.conf.unset(key)
