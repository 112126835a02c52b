"""Tables written by an upstream layer, read as a snapshot or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """With a ``schema``, also a table that has no files yet can be read. Folders of batches and buckets are no columns."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.option("recursiveFileLookup", True).parquet(path)


def stream_table(spark: SparkSession, path: str, schema: StructType, **options: str | int) -> DataFrame:
    """``options`` are those of the file source, such as ``maxBytesPerTrigger`` (a number of bytes)."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.options(**options).parquet(path)
