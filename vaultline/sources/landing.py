"""Landing folders of JSON files, one folder per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vaultline.schemas import INGESTED_AT, MALFORMED, SOURCE_FILE, SOURCE_TIME

CATALOG_KEY = "catalog_name"
DEFAULT_CATALOG = "bank_dev"


def landing_base(spark: SparkSession, root: str = "/data") -> str:
    """Folder of all entities below the catalog named in the session configuration."""
    catalog = spark.conf.get(CATALOG_KEY, DEFAULT_CATALOG)
    return f"{root}/{catalog}/raw_data/landing"


def landing_path(spark: SparkSession, entity: str, root: str = "/data") -> str:
    return f"{landing_base(spark, root)}/{entity}/"


def with_lineage(files: DataFrame) -> DataFrame:
    """Ingest time, file of origin and when that was written; must sit directly on the file scan."""
    return files.withColumns(
        {
            INGESTED_AT: F.current_timestamp(),
            SOURCE_FILE: F.col("_metadata.file_path"),
            SOURCE_TIME: F.col("_metadata.file_modification_time"),
        }
    )


def keeping_malformed(schema: StructType) -> StructType:
    """``schema`` with a column for the text of records that are broken or hold values of another type."""
    return StructType([*schema.fields, StructField(MALFORMED, StringType(), True)])


def read_landing(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Records that do not fit ``schema`` keep their text in a column of its own."""
    reader = spark.read.schema(keeping_malformed(schema)).option("multiLine", multi_line)
    return with_lineage(reader.option("columnNameOfCorruptRecord", MALFORMED).json(path))


def stream_landing(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, **options: str | int
) -> DataFrame:
    """Each file is read once; the query's checkpoint remembers which were.

    Of the file source's ``options``, ``maxBytesPerTrigger`` or ``maxFilesPerTrigger`` keep the
    batches of a large backlog to a size the cluster can take at once.
    """
    reader = spark.readStream.schema(keeping_malformed(schema)).option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED).options(**options)
    return with_lineage(reader.json(path))


def infer_schema(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> StructType:
    """Types found in all the files, fields in name order. Keep the result fixed, see ``sources.fields``."""
    reader = spark.read.option("multiLine", multi_line).option("inferTimestamp", False)
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return StructType([f for f in reader.json(path).schema.fields if f.name != MALFORMED])


def unknown_fields(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> list[StructField]:
    """Fields of the landed records that ``schema`` does not name, by one pass over the files."""
    return [f for f in infer_schema(spark, path, multi_line).fields if f.name not in schema.names]
