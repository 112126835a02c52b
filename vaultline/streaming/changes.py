"""Change capture on a stream, without a table format that can merge.

Each micro-batch leaves the newest row of the keys it touched, deletes included, in a folder of its
own; a replayed batch overwrites the same folder with the same rows. Writing therefore costs as much
as the change, not as the table. The current table is the newest row per key over these folders and a base,
and ``compact`` folds them into the base now and then and removes what it folded, so that neither
reading nor the number of folders grows with history. The base lies in buckets of the key, and folding
rewrites only those that hold a changed key. The table starts with an empty base and a batch without rows,
so it can be read, and named in the catalog, before the first change.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from vaultline.operators.changes import ChangeFeed
from vaultline.sinks.files import children, exists, remove, replace_partitions, settle
from vaultline.sinks.tables import create_view
from vaultline.streaming.batches import BATCH, BEFORE_ALL, BUCKET, BUCKETS, bucket_of, bucketed

# The bucket of the empty base; those of rows start at 0.
NO_BUCKET = -1


def start_changes(spark: SparkSession, schema: StructType, feed: ChangeFeed, target: str) -> None:
    """An empty table, once; fields that are new since then are added to it."""
    if any("/upto=" in path for path in children(spark, f"{target}/base")):
        raise ValueError(f"{target} was written by an earlier version; run its stream again into a folder of its own")
    empty = feed.newest(spark.createDataFrame([], schema))
    without_rows = f"{target}/changes/{BATCH}={BEFORE_ALL}"
    if not exists(spark, without_rows) or not set(empty.columns) <= set(_schema(spark, without_rows).names):
        for folder in (f"{target}/base/{BUCKET}={NO_BUCKET}", without_rows):
            empty.write.mode("append").parquet(folder)


def write_changes(changes: DataFrame, feed: ChangeFeed, target: str, checkpoint: str) -> DataStreamWriter:
    start_changes(changes.sparkSession, changes.schema, feed, target)

    def store(batch: DataFrame, number: int) -> None:
        feed.newest(batch).write.mode("overwrite").parquet(f"{target}/changes/{BATCH}={number}")

    return changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)


def _schema(spark: SparkSession, folder: str) -> StructType:
    """All fields so far, as the few files without rows in ``folder`` tell."""
    return spark.read.option("mergeSchema", True).parquet(folder).schema


def _stored(spark: SparkSession, target: str, part: str) -> DataFrame:
    """With all the columns that any file has: a field may be found after the first buckets were written."""
    known = _schema(spark, f"{target}/changes/{BATCH}={BEFORE_ALL}")
    return spark.read.schema(known).parquet(f"{target}/{part}")


def _newest(feed: ChangeFeed, base: DataFrame, changes: DataFrame) -> DataFrame:
    return feed.newest(base.drop(BUCKET).unionByName(changes.drop(BATCH, BUCKET), allowMissingColumns=True))


def read_newest(spark: SparkSession, feed: ChangeFeed, target: str) -> DataFrame:
    """The newest row of every key, deletes included."""
    settle(spark, f"{target}/base")
    return _newest(feed, _stored(spark, target, "base"), _stored(spark, target, "changes"))


def read_current(spark: SparkSession, feed: ChangeFeed, target: str) -> DataFrame:
    return feed.live(read_newest(spark, feed, target))


def compact(spark: SparkSession, feed: ChangeFeed, target: str, buckets: int = BUCKETS) -> int:
    """Fold all batches so far into the base and remove what was folded; returns the last batch folded in.

    Only buckets with a changed key are written anew; keep ``buckets`` as long as the table lives. Deletes stay,
    so that late older rows still lose against them. A run that breaks off loses nothing: the changes are
    there until the base has them, and folding them twice gives the same rows. Run it between stream runs,
    when nobody reads the table.
    """
    settle(spark, f"{target}/base")
    folders = {int(p.rpartition("=")[2]): p for p in children(spark, f"{target}/changes") if f"/{BATCH}=" in p}
    last = max(folders)
    if last > BEFORE_ALL:
        changes = _stored(spark, target, "changes").where(F.col(BATCH) <= last)
        changes = changes.withColumn(BUCKET, bucket_of(feed.keys, buckets))
        touched = [row[BUCKET] for row in changes.select(BUCKET).distinct().collect()]  # at most all buckets
        base = _stored(spark, target, "base").where(F.col(BUCKET).isin(touched))
        replace_partitions(bucketed(_newest(feed, base, changes), feed.keys, buckets), f"{target}/base", BUCKET)
        marker = spark.range(1).select(F.lit(last).cast("long").alias("upto"))
        marker.write.mode("append").parquet(f"{target}/finished")
        for number, folder in folders.items():
            if BEFORE_ALL < number <= last:
                remove(spark, folder)
        spark.catalog.refreshByPath(target)
    if not exists(spark, f"{target}/finished"):
        return BEFORE_ALL
    return spark.read.parquet(f"{target}/finished").agg(F.max("upto")).first()[0]


def name_changes(
    spark: SparkSession, view: str, feed: ChangeFeed, target: str, schema: StructType, comment: str, tags: Mapping[str, str]
) -> None:
    """The current table as a view of the catalog with a comment and tags, for any reader and before any change.

    ``schema`` is that of the changes; a table that isn't there yet is started. The view reads base and changes
    anew with every query.
    """
    start_changes(spark, schema, feed, target)
    names = [c for c in schema.names if c not in feed.except_columns]
    columns = ", ".join(f"`{c}`" for c in names)
    rest = ", ".join(f"`{c}`" for c in names if c not in feed.keys)
    order = ", ".join(f"{s} DESC NULLS LAST" for s in feed.sequence)
    kept = f"NOT coalesce({feed.delete_when}, false)" if feed.delete_when else "true"
    parts = " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{target}/{part}` WITH (mergeSchema = true)" for part in ("base", "changes"))
    create_view(
        spark,
        view,
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(f'`{k}`' for k in feed.keys)} "
        f"ORDER BY {order}, xxhash64({rest})) AS _position FROM ({parts})) WHERE _position = 1 AND {kept}",
        comment,
        tags,
    )
