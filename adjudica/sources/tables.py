"""Flat tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

LOOKS_AT_ONCE = 16


def read_parquet(spark: SparkSession, *paths: str, columns: Sequence[str] | None = None, schema=None) -> DataFrame:
    """Parquet files; missing and unreadable ones are passed over, empty ones add nothing."""
    reader = spark.read.option("ignoreMissingFiles", True).option("ignoreCorruptFiles", True)
    df = (reader.schema(schema) if schema is not None else reader).parquet(*paths)
    return df.select(*columns) if columns else df


def read_lines(spark: SparkSession, *paths: str, schema) -> DataFrame:
    """JSON lines with a fixed schema: unknown fields are dropped, absent ones are null."""
    return spark.read.schema(schema).json(list(paths))


def read_csv(
    spark: SparkSession,
    *paths: str,
    schema,
    columns: Sequence[str] | None = None,
    separator: str = ",",
    encoding: str = "UTF-8",
    null_value: str = "",
) -> DataFrame:
    """CSV with a header and a fixed schema in file order."""
    reader = spark.read.options(header=True, sep=separator, encoding=encoding, nullValue=null_value)
    df = reader.schema(schema).csv(list(paths))
    return df.select(*columns) if columns else df


def read_csv_texts(spark: SparkSession, *paths: str, columns: Sequence[str], separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Named columns of CSV files as text, whatever other columns they have and in any order."""
    df = spark.read.options(header=True, sep=separator, encoding=encoding).csv(list(paths))
    return df.select(*[F.col(c).cast("string") for c in columns])


def text_schema(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int | None]:
    """Bytes of each file, none where it doesn't exist: one look per path, by the file system Spark would use."""
    hadoop, to_path = spark._jsc.hadoopConfiguration(), spark._jvm.org.apache.hadoop.fs.Path

    def size(path: str) -> int | None:
        place = to_path(path)
        system = place.getFileSystem(hadoop)
        return system.getContentSummary(place).getLength() if system.exists(place) else None

    # A look is mostly waiting for the file system.
    with ThreadPoolExecutor(LOOKS_AT_ONCE) as looks:
        return dict(zip(paths, looks.map(size, paths)))
