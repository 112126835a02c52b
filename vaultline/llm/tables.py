"""Reading the given tables, cutting lineage in the shared folder, and the split of the labels."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.session import scratch_dir

BUCKETS = 1 << 22  # bound of a broadcast filter on keys
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read back from the shared folder: a lost executor costs no earlier step, and Spark
    knows the size of the table when it plans a join with it."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts are long: fewer of them in an Arrow batch bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """``short_batches`` for what is written meanwhile; the session's own setting is back afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def held_out(doc_id: Column) -> Column:
    """Rows kept from every training; a null id is not held out, and has no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def near_keys(df: DataFrame, keys: list[str], of: DataFrame) -> DataFrame:
    """The rows of ``df`` whose keys fall into a bucket with a key of ``of``: all that match, and few more.

    Nothing is shuffled: at most BUCKETS numbers are broadcast. An exact join comes after it; on tables so
    large that most buckets are taken, that join alone does the work.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    taken = of.select(bucket.alias("near_bucket")).distinct()
    return df.join(F.broadcast(taken), bucket == taken["near_bucket"], "left_semi")
