"""Catalog tables carrying a comment and tags."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from vaultline.sinks.files import children, remove


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _described(comment: str, tags: Mapping[str, str]) -> str:
    properties = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in tags.items())
    return f"COMMENT {_quoted(comment)}" + (f" TBLPROPERTIES ({properties})" if tags else "")


def _definition(table: str, path: str, comment: str, tags: Mapping[str, str]) -> str:
    return (
        f"{table} USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION {_quoted(path)} "
        f"{_described(comment, tags)}"
    )


def create_tagged(df: DataFrame, table: str, path: str, comment: str, tags: Mapping[str, str]) -> None:
    """Create ``table`` at ``path`` from ``df`` with a comment and table properties."""
    view = f"_tagged_{uuid.uuid4().hex}"
    df.createTempView(view)
    try:
        df.sparkSession.sql(
            f"CREATE TABLE {_definition(table, path, comment, tags)} AS SELECT * FROM {view}"
        )
    finally:
        df.sparkSession.catalog.dropTempView(view)


def register_tagged(
    spark: SparkSession, table: str, path: str, comment: str, tags: Mapping[str, str]
) -> None:
    """Name data already stored at ``path``, with a comment and table properties."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_definition(table, path, comment, tags)}")


def _versions(spark: SparkSession, root: str) -> dict[int, str]:
    return {int(p.rpartition("=")[2]): p for p in children(spark, root) if "/version=" in p}


def switch_table(
    df: DataFrame, table: str, root: str, comment: str, tags: Mapping[str, str], keep: int = 2
) -> int:
    """Replace the catalog table at one stroke: a new folder below ``root`` is written, then the table points to it.

    Readers have the old rows or the new ones, and those who have begun to read go on with the folder they
    found: the last ``keep`` versions stay. A column that is new is added; one that is missing is an error. A run
    that breaks off leaves the table as it was. Returns the number of the version.
    """
    spark = df.sparkSession
    number = max(_versions(spark, root), default=0) + 1
    folder = f"{root}/version={number}"
    if spark.catalog.tableExists(table):
        stored = {f.name: f.dataType for f in spark.table(table).schema.fields}
        fields = {f.name: f.dataType for f in df.schema.fields}
        changed = [c for c in stored if fields.get(c) != stored[c]]
        if changed:
            raise ValueError(f"{table} would lose or change columns: {changed}")
        df.select(*stored, *(c for c in fields if c not in stored)).write.parquet(folder)
        new = ", ".join(f"`{c}` {fields[c].simpleString()}" for c in fields if c not in stored)
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({new})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_quoted(folder)}")
    else:
        df.write.parquet(folder)
        register_tagged(spark, table, folder, comment, tags)
    for old, path in _versions(spark, root).items():
        if old < number - keep:
            remove(spark, path)
    return number


def create_view(spark: SparkSession, view: str, query: str, comment: str, tags: Mapping[str, str]) -> None:
    """A view that stays in the catalog, in place of one of this name."""
    spark.sql(f"CREATE OR REPLACE VIEW {view} {_described(comment, tags)} AS {query}")


def table_tags(spark: SparkSession, table: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
