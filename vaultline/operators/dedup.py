"""One row per key: the first to arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.schemas import INGESTED_AT, SOURCE_FILE, SOURCE_TIME

ARRIVAL = (SOURCE_TIME, INGESTED_AT, SOURCE_FILE)


def leading_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that sorts first; ties go by a hash of the other columns, so reruns agree.

    Spark cuts ``row_number() = 1`` down to one row per key and task before it shuffles, so a key
    that owns much of the table costs no more than any other. The hash is made before the shuffle, so
    columns that nobody reads later are not shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*order, "_tie")
    return (
        df.withColumn("_tie", F.xxhash64(*rest) if rest else F.lit(0))
        .withColumn("_position", F.row_number().over(ranked))
        .filter(F.col("_position") == 1)
        .drop("_position", "_tie")
    )


def first_per_key(
    df: DataFrame, keys: Sequence[str], arrival: Sequence[str] = ARRIVAL, salts: int = 0
) -> DataFrame:
    """First arrival per key. A stream keeps every key it has ever seen in the state store.

    On a stream, the first batch that has a key wins it, but any of the copies within that batch may be kept, as
    a stateful operator takes rows in the order in which they come out of a shuffle. Where that order counts,
    use ``streaming.batches.write_first``, as the refresh does. ``salts`` lets the copies of a key first meet in that many groups, each passing on
    one row, before they meet as a key. It relieves the task of a key with very many copies, such as the
    rows without a key, at the price of a second state.
    """
    if df.isStreaming:
        if salts:
            salt = F.pmod(F.spark_partition_id(), F.lit(salts))
            df = df.withColumn("_salt", salt).dropDuplicates([*keys, "_salt"]).drop("_salt")
        return df.dropDuplicates(list(keys))
    return leading_row(df, keys, [F.col(c).asc_nulls_first() for c in arrival if c in df.columns])
