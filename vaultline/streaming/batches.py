"""Tables that a stream fills, without a table format: each micro-batch leaves its rows in a folder of its own.

A batch that is run again replaces its own folder with the same rows, so every row is there exactly once. A
table starts with the folder of a batch before the first, without rows, so it can be read at any time. It
may deal out its rows to buckets of a key, so that later changes of a few keys rewrite a few folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from vaultline.operators.dedup import ARRIVAL, leading_row
from vaultline.sinks.files import children, exists, remove, replace_partitions, settle

BATCH, BUCKET = "batch", "bucket"
KNOWN = "_known"  # marks a key that an earlier batch had
BEFORE_ALL = -1  # batch ids start at 0
BUCKETS = 64  # of one table; keep the number as long as the table lives

Refine = Callable[[DataFrame, int], DataFrame]  # of a batch and its number
Done = Callable[[int], None]  # what to do once a batch is written


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row. Rows without a key share one."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """With its bucket, and gathered by it; Spark splits a bucket that holds much of the table, and joins small ones."""
    return df.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", F.col(BUCKET))


def write_batch(df: DataFrame, path: str, batch: int, keys: Sequence[str] = (), buckets: int = BUCKETS) -> None:
    folder = f"{path}/{BATCH}={batch}"
    if keys:
        bucketed(df, keys, buckets).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    else:
        df.write.mode("overwrite").parquet(folder)


def start_table(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ()) -> None:
    """The folder before all batches, once. A table of another kind at ``path`` is an error."""
    if exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} was written by an earlier version's stream; give this one folders of its own")
    folder = f"{path}/{BATCH}={BEFORE_ALL}"
    if not exists(spark, folder):
        inner = f"{folder}/{BUCKET}={BEFORE_ALL}" if keys else folder
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(inner)


def write_batches(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    refine: Refine,
    keys: Sequence[str] = (),
    buckets: int = BUCKETS,
    done: Done = lambda number: None,
) -> DataStreamWriter:
    """A stream whose batches, refined, make the table at ``path``, in buckets of ``keys`` if there are any."""

    def store(batch: DataFrame, number: int) -> None:
        write_batch(refine(batch, number), path, number, keys, buckets)
        done(number)

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


# --- first arrivals ---------------------------------------------------------------------------


def unseen(batch: DataFrame, number: int, keys: Sequence[str], order: Sequence[Column], ledger: str) -> DataFrame:
    """The first row of each key of a batch, by ``order``, that no earlier batch had. ``ledger`` holds the keys of all.

    Known keys run along with the batch as rows that come before all others, so that rows are shuffled once, by
    their key, and known ones as keys alone; a missing key is one like any other. The mark is null for rows of
    the batch, so it leaves their hash, and with it the order of ties, as it is.
    """
    known = batch.sparkSession.read.parquet(ledger).where(F.col(BATCH) < number)
    known = known.select(*keys, F.lit(True).alias(KNOWN))
    both = batch.withColumn(KNOWN, F.lit(None).cast("boolean")).unionByName(known, allowMissingColumns=True)
    first = leading_row(both, keys, [F.col(KNOWN).desc_nulls_last(), *order])
    return first.where(F.col(KNOWN).isNull()).drop(KNOWN)


def write_first(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    ledger: str,
    refine: Refine = lambda fresh, number: fresh,
    arrival: Sequence[str] = ARRIVAL,
    bucket_keys: Sequence[str] = (),
    buckets: int = BUCKETS,
    done: Done = lambda number: None,
) -> DataStreamWriter:
    """A table with the first row of each key to arrive, whatever batch and whatever order in a batch.

    An earlier batch comes first, and within a batch the row that is first by ``arrival``; ties go by the rest of
    the row, so a batch that is run again keeps the same rows. ``refine`` works on the first rows only: what it
    drops stays known, and no later copy takes its place.
    """
    spark = rows.sparkSession
    start_table(spark, ledger, StructType([rows.schema[k] for k in keys]))

    def store(batch: DataFrame, number: int) -> None:
        order = [F.col(c).asc_nulls_first() for c in arrival if c in batch.columns]
        fresh = unseen(batch, number, keys, order, ledger).persist()
        try:
            write_batch(fresh.select(*keys), ledger, number)
            write_batch(refine(fresh, number), path, number, bucket_keys, buckets)
            done(number)
        finally:
            fresh.unpersist()

    return rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def fold_ledger(spark: SparkSession, ledger: str) -> int:
    """Puts the keys of all batches but the last into the folder before all, so that files stay few.

    The last batch may be run again, and must not find its own keys there. Run it between stream runs; where it
    breaks off, some keys are there twice, which changes nothing, and the next one goes on.
    """
    settle(spark, ledger)
    numbers = [int(path.rpartition("=")[2]) for path in children(spark, ledger) if f"/{BATCH}=" in path]
    last = max(numbers, default=BEFORE_ALL)
    done = [n for n in numbers if BEFORE_ALL < n < last]
    if done:
        keys = spark.read.parquet(ledger).where(F.col(BATCH) < last)
        replace_partitions(keys.withColumn(BATCH, F.lit(BEFORE_ALL)).distinct(), ledger, BATCH)
        for number in done:
            remove(spark, f"{ledger}/{BATCH}={number}")
        spark.catalog.refreshByPath(ledger)
    return len(done)
