"""Fields that landed records have beyond the known ones, kept from run to run.

A field keeps the type with which it was found first; later values of another type stay with their record's text, as
those of the known fields do. Only files that were not looked at yet are read for it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from vaultline.sinks.files import exists
from vaultline.sources.landing import infer_schema

FIELDS = "position int, name string, field string"
FILES = "path string"


def kept_fields(spark: SparkSession, log: str) -> list[StructField]:
    """The fields found so far, in the order in which they were found."""
    if not exists(spark, f"{log}/fields"):
        return []
    rows = spark.read.schema(FIELDS).parquet(f"{log}/fields").orderBy("position", "name").collect()
    first: dict[str, StructField] = {}
    for row in rows:
        first.setdefault(row["name"], StructField.fromJson(json.loads(row["field"])))
    return list(first.values())


def _unseen(spark: SparkSession, landing: str, log: str, pattern: str) -> DataFrame:
    """Paths of the landed files that no run has looked at; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    paths = files.load(landing).select("path")
    if not exists(spark, f"{log}/files"):
        return paths
    return paths.join(spark.read.schema(FILES).parquet(f"{log}/files"), "path", "left_anti")


def note_fields(
    spark: SparkSession, landing: str, schema: StructType, log: str, multi_line: bool = False, pattern: str = "*.json"
) -> list[StructField]:
    """All fields found so far beyond ``schema``, after a look at the files that landed since the last run.

    Fields are noted before the files that they came from, so a run that breaks off in between looks at the files
    again and finds what it knows.
    """
    paths = [row["path"] for row in _unseen(spark, landing, log, pattern).collect()]
    known = kept_fields(spark, log)
    if not paths:
        return known
    taken = {*schema.names, *(f.name for f in known)}
    found = [f for f in infer_schema(spark, paths, multi_line).fields if f.name not in taken]
    if found:
        rows = [(len(known) + i, f.name, json.dumps(f.jsonValue())) for i, f in enumerate(found)]
        spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(f"{log}/fields")
    seen = spark.createDataFrame([(p,) for p in paths], FILES)
    seen.coalesce(1).write.mode("append").parquet(f"{log}/files")
    return [*known, *found]
