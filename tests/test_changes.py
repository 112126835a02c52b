import os
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vaultline.operators.changes import ChangeFeed, apply_changes
from vaultline.session import scratch_dir
from vaultline.sources.tables import stream_table
from vaultline.streaming.changes import compact, read_current, write_changes
from vaultline.streaming.run import run_available

FEED = ChangeFeed(keys=("k",), sequence=("seq", "tie"), delete_when="gone = true", except_columns=("src",))
SCHEMA = "k string, seq int, tie int, gone boolean, v string, src string"


def expected(rows):
    """Brute force: the row with the greatest (sequence, tie) per key, NULL lowest, unless a delete."""
    newest = {}
    for row in rows:
        rank = tuple((x is not None, x or 0) for x in row[1:3])
        if row[0] not in newest or rank > newest[row[0]][0]:
            newest[row[0]] = (rank, row)
    return sorted(row[:5] for _, row in newest.values() if row[3] is not True)


def found(df):
    assert df.columns == ["k", "seq", "tie", "gone", "v"]
    return sorted(tuple(r) for r in df.collect())


def test_updates_deletes_and_reinsertion(spark):
    rows = [
        ("updated", 1, 0, False, "old", "f"),
        ("updated", 2, 0, False, "new", "f"),
        ("deleted", 1, 0, False, "x", "f"),
        ("deleted", 2, 0, True, "x", "f"),
        ("back", 1, 0, True, "x", "f"),
        ("back", 2, 0, False, "again", "f"),
        ("unknown flag", 1, 0, None, "kept", "f"),
        ("no sequence", None, 0, False, "oldest", "f"),
        ("no sequence", 0, 0, False, "newest", "f"),
        ("only null", None, None, False, "kept", "f"),
    ]
    assert found(apply_changes(spark.createDataFrame(rows, SCHEMA), FEED)) == expected(rows)


def feed_rows(seed, n=120):
    rng = random.Random(seed)
    return [
        (
            f"k{rng.randrange(12)}",
            rng.choice([None, *range(20)]),
            i,
            rng.choice([True, False, False, None]),
            f"v{i}",
            "f",
        )
        for i in range(n)
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), partitions=st.integers(1, 6), data=st.randoms(use_true_random=False))
def test_any_order_and_layout_gives_the_same_table(spark, seed, partitions, data):
    rows = feed_rows(seed)
    shuffled = rows[:]
    data.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, SCHEMA).repartition(partitions)
    assert found(apply_changes(frame, FEED)) == expected(rows)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    seed=st.integers(0, 10_000),
    cuts=st.lists(st.integers(1, 119), min_size=1, max_size=3, unique=True),
    fold=st.booleans(),
)
def test_any_split_into_stream_runs_gives_the_same_table(spark, seed, cuts, fold):
    root = scratch_dir(spark, "test")
    rows = feed_rows(seed)
    random.Random(seed).shuffle(rows)
    edges = [0, *sorted(cuts), len(rows)]
    for part, (low, high) in enumerate(zip(edges, edges[1:])):
        spark.createDataFrame(rows[low:high], SCHEMA).write.parquet(f"{root}/landing/part_{part}")
        source = stream_table(spark, f"{root}/landing/*", spark.createDataFrame([], SCHEMA).schema)
        run_available(write_changes(source, FEED, f"{root}/target", f"{root}/checkpoint"))
        if fold:
            compact(spark, FEED, f"{root}/target")
        assert found(read_current(spark, FEED, f"{root}/target")) == expected(rows[:high])


def test_late_older_row_does_not_revive_a_deleted_key(spark, scratch):
    runs = [[("a", 5, 0, True, "gone", "f")], [("a", 3, 0, False, "late", "f")]]
    for part, rows in enumerate(runs):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/landing/part_{part}")
        source = stream_table(spark, f"{scratch}/landing/*", spark.createDataFrame([], SCHEMA).schema)
        run_available(write_changes(source, FEED, f"{scratch}/target", f"{scratch}/checkpoint"))
        compact(spark, FEED, f"{scratch}/target")
        assert found(read_current(spark, FEED, f"{scratch}/target")) == []


def test_compaction_is_repeatable_and_ignores_an_unfinished_base(spark, scratch):
    rows = feed_rows(1)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/landing/part_0")
    source = stream_table(spark, f"{scratch}/landing/*", spark.createDataFrame([], SCHEMA).schema)
    run_available(write_changes(source, FEED, f"{scratch}/target", f"{scratch}/checkpoint"))
    # What a compaction that broke off while it wrote leaves behind.
    spark.createDataFrame(rows[:1], SCHEMA).drop("src").write.parquet(f"{scratch}/target/base/_coming/bucket=0")
    assert found(read_current(spark, FEED, f"{scratch}/target")) == expected(rows)
    assert [compact(spark, FEED, f"{scratch}/target") for _ in range(3)] == [0, 0, 0]
    assert found(read_current(spark, FEED, f"{scratch}/target")) == expected(rows)


def test_a_batch_that_is_run_again_changes_nothing(spark, scratch):
    rows = feed_rows(2)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{scratch}/landing/part_0")
    source = stream_table(spark, f"{scratch}/landing/*", spark.createDataFrame([], SCHEMA).schema)

    def run():
        done = run_available(write_changes(source, FEED, f"{scratch}/target", f"{scratch}/checkpoint"))
        return [p.batchId for p in done if p.numInputRows]

    assert run() == [0]
    # As after a driver that was lost between writing the batch and noting that it is done.
    for name in ("0", ".0.crc"):
        os.remove(f"{scratch}/checkpoint/commits/{name}")
    assert run() == [0]
    assert found(read_current(spark, FEED, f"{scratch}/target")) == expected(rows)
