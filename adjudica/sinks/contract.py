"""Description of the published columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from adjudica.sources.layouts import CONTRACT, DECLARED_TYPES

# Type names of the published description.
TYPE_NAMES = {
    "string": "string",
    "float": "number",
    "double": "number",
    "smallint": "integer",
    "boolean": "boolean",
    "date": "date",
}


def contract_rows(df: DataFrame) -> DataFrame:
    """The columns of a table as rows: name, type in the published vocabulary and Spark's own type."""
    rows = [(f.name, TYPE_NAMES.get(f.dataType.simpleString(), "string"), f.dataType.simpleString()) for f in df.schema]
    return df.sparkSession.createDataFrame(rows, "name string, actual_type string, spark_type string")


def base_contract(df: DataFrame) -> DataFrame:
    """The titled columns, in published order."""
    rows = [
        (i, name, title, DECLARED_TYPES.get(name, TYPE_NAMES[kind.simpleString()])) for i, (name, title, kind) in enumerate(CONTRACT)
    ]
    return df.sparkSession.createDataFrame(rows, "position int, name string, title string, type string")


def read_contract(spark: SparkSession, path: str) -> DataFrame:
    """A description kept as a JSON document: its ordered fields with their metadata."""
    fields = (
        "fields array<struct<name:string,title:string,short_title:string,type:string,format:string,"
        "description:string,enum:array<string>>>"
    )
    document = spark.read.schema(fields).json(path, multiLine=True)
    return document.select(F.posexplode("fields").alias("position", "field")).select("position", "field.*")


def described(df: DataFrame, base: DataFrame, metadata: Sequence[str] = ("title",)) -> DataFrame:
    """Titled columns with their declared type; the type found stands beside it.

    Columns of the table that the contract does not title are left out. Both sides are as small as a
    table is wide.
    """
    return (
        base.join(F.broadcast(contract_rows(df)), "name", "left")
        .where(F.col("title").isNotNull())
        .select("position", "name", *metadata, F.coalesce("type", "actual_type").alias("type"), "actual_type")
    )


def contract_document(df: DataFrame, base: DataFrame) -> DataFrame:
    """All described columns in one row, by name, ready to be written as one JSON document."""
    metadata = [c for c in base.columns if c not in ("position", "name", "type")]
    fields = F.struct("name", *metadata, "type", "actual_type")
    return described(df, base, metadata).agg(F.array_sort(F.collect_list(fields)).alias("fields"))
