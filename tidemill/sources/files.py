"""File scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv_dir(
    spark: SparkSession, path: str, schema: T.StructType | str, streaming: bool = False, glob: str = "*.csv"
) -> DataFrame:
    """All CSV files of a folder, each with a header row."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).option("header", True).option("pathGlobFilter", glob).csv(path)


def read_csv_lines(spark: SparkSession, path: str, streaming: bool = False, glob: str = "*.csv") -> DataFrame:
    """CSV lines as raw text in ``value``, without the header row of each file.

    The CSV source drops the header per file, also when a file is split; with a separator
    that cannot occur and no quotes the rest of the line stays as it is.
    """
    reader = spark.readStream if streaming else spark.read
    return (
        reader.schema("value string")
        .option("header", True)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escape", "")
        .option("enforceSchema", True)
        .option("pathGlobFilter", glob)
        .csv(path)
    )


def read_json_lines(
    spark: SparkSession, path: str, schema: T.StructType | str, streaming: bool = False
) -> DataFrame:
    """JSON lines against a known schema; nothing is inferred."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; ``spark.sql.files.maxPartitionBytes`` decides its splits."""
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table as a file stream.  The path is written as a pattern that only itself
    matches: that way it may name a single file as well as a folder of parts."""
    schema = spark.read.parquet(path).schema
    whole = path.rstrip("/")
    return spark.readStream.schema(schema).parquet(f"{whole[:-1]}[{whole[-1]}]")
