"""Table files. Spark's commit makes a written table appear whole or not at all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", mode: str = "overwrite") -> DataFrame:
    """Write and return the written table."""
    df.write.mode(mode).parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')


def write_table(df: DataFrame, path: str, formats: Sequence[str] = ("parquet", "csv")) -> DataFrame:
    """Write a table in the given formats; CSV comes from the Parquet just written, not from the plan."""
    written = write_parquet(df, f"{path}.parquet") if "parquet" in formats else df
    if "csv" in formats:
        write_csv(written, f"{path}.csv")
    return written


def write_document(df: DataFrame, path: str) -> None:
    """A report of one row as one JSON document."""
    df.coalesce(1).write.mode("overwrite").json(path)


def write_by_month(df: DataFrame, path: str, date: str, source: str, mode: str = "overwrite") -> None:
    """Collected records as JSON lines, one folder per month, marked with the collector's name."""
    marked = df.drop("$schema").withColumns(
        {"month": F.substring(F.col(date).cast("string"), 1, 7), "source": F.lit(source)}
    )
    # A large month is spread over several files, small months do not leave one per task.
    marked.hint("rebalance", "month").write.mode(mode).partitionBy("month").json(path)
