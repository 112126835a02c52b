"""Path sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Folders and files that readers of a table pass over.
COMING, WHOLE = "_coming", "_whole"


def append_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append-only Parquet table fed by a stream; the file sink's log makes it exactly-once."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def overwrite(df: DataFrame, path: str, columns: Sequence[str] = ()) -> None:
    """Replace the table at ``path``, in folders of ``columns`` if there are any.

    It is written beside it first, so a plan that fails leaves the old one.
    """
    new, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").partitionBy(*columns).parquet(new)
    spark = df.sparkSession
    if exists(spark, path):
        remove(spark, old)
        _move(spark, path, old)
    _move(spark, new, path)
    remove(spark, old)
    spark.catalog.refreshByPath(path)


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    files, place = _at(spark, path)
    return [str(found.getPath()) for found in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def _move(spark: SparkSession, path: str, to: str) -> None:
    files, place = _at(spark, path)
    if not files.rename(place, _at(spark, to)[1]):
        raise OSError(f"cannot move {path} to {to}")


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The partition folders below ``path`` that hold files, or ``path`` itself if it has none."""
    files, place = _at(spark, path)
    inner = [str(f.getPath()) for f in files.listStatus(place) if f.isDirectory() and "=" in f.getPath().getName()]
    return [leaf for folder in inner for leaf in _folders(spark, folder)] or [path]


def replace_partitions(df: DataFrame, path: str, *columns: str) -> list[str]:
    """Put the partitions of ``df`` (by ``columns``) in the place of those that the table at ``path`` has.

    Other partitions keep their files. The new ones are written beside the table first, and are moved in one
    by one once all are there; should that break off, ``settle`` goes on with it. Returns the folders.
    """
    spark = df.sparkSession
    settle(spark, path)
    df.write.mode("overwrite").partitionBy(*columns).parquet(f"{path}/{COMING}")
    files, place = _at(spark, f"{path}/{COMING}/{WHOLE}")
    files.create(place).close()
    return settle(spark, path)


def settle(spark: SparkSession, path: str) -> list[str]:
    """Moves partitions that were written whole into their places; what was not written to its end is dropped."""
    coming = f"{path}/{COMING}"
    moved = []
    if exists(spark, f"{coming}/{WHOLE}"):
        base = str(_at(spark, coming)[0].makeQualified(_at(spark, coming)[1]))
        for folder in _folders(spark, base):
            if folder != base:
                place = f"{path}/{folder[len(base) + 1 :]}"
                remove(spark, place)
                files, parent = _at(spark, place.rpartition("/")[0])
                files.mkdirs(parent)
                _move(spark, folder, place)
                moved.append(place)
        spark.catalog.refreshByPath(path)
    if exists(spark, coming):
        remove(spark, coming)
    return moved


def clustered(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Range-partitioned and sorted by ``columns`` so that readers skip files and row groups by min/max."""
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns)


def write_clustered(df: DataFrame, path: str, *columns: str, partitions: int | None = None) -> None:
    overwrite(clustered(df, *columns, partitions=partitions), path)


def range_bounds(df: DataFrame, columns: Sequence[str], ranges: int, rows: int = 20_000) -> dict[str, list]:
    """Values that cut each column in so many ranges of about equally many rows, from a sample of about ``rows`` rows.

    The sample is that of the rows' hashes, so it does not change from run to run, and bounded.
    """
    total = df.count()
    keep = 1.0 if total <= rows else rows / total
    hashed = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int(keep * (1 << 30)) + 1
    sample = df.where(hashed).select(*columns).limit(2 * rows).collect()
    bounds = {}
    for column in columns:
        values = sorted(row[column] for row in sample if row[column] is not None)
        cuts = [values[len(values) * i // ranges] for i in range(1, ranges)] if values else []
        bounds[column] = sorted(set(cuts))
    return bounds


def interleaved(df: DataFrame, *columns: str, partitions: int, bits: int = 6) -> DataFrame:
    """Partitioned by several columns at once, so that readers skip files on any of them.

    Each column is cut in ``2 ** bits`` ranges, and the bits of a row's ranges take turns in the number by which
    rows are dealt out and sorted; rows that are near in all columns lie together. Nulls are in the first range.
    """
    bounds = range_bounds(df, columns, 1 << bits)
    number = F.lit(0).cast("long")
    for k, column in enumerate(columns):
        cuts = bounds[column]
        place = F.lit(0)
        if cuts:
            kind = df.schema[column].dataType
            listed = F.array(*(F.lit(cut).cast(kind) for cut in cuts))
            place = F.coalesce(F.size(F.filter(listed, lambda cut: cut <= F.col(column))), F.lit(0))
            place = F.when(F.col(column).isNull(), 0).otherwise(place)
        for bit in range(bits):
            one = F.shiftright(place.cast("long"), bit).bitwiseAND(F.lit(1))
            number = number.bitwiseOR(F.shiftleft(one, bit * len(columns) + k))
    dealt = df.withColumn("_interleaved", number).repartitionByRange(partitions, "_interleaved")
    return dealt.sortWithinPartitions("_interleaved", *columns).drop("_interleaved")


def write_interleaved(df: DataFrame, path: str, *columns: str, partitions: int, bits: int = 6) -> None:
    overwrite(interleaved(df, *columns, partitions=partitions, bits=bits), path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines, one object per line, so that large files stay splittable."""
    df.write.mode("overwrite").json(path)
