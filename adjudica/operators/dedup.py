"""Deduplication with a survivor that does not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def row_order(df: DataFrame, leave_out: Sequence[str] = ()) -> list[Column]:
    """A total order over the rows of a table: its columns, in name order."""
    return [F.col(f"`{c}`").asc_nulls_last() for c in sorted(df.columns) if c not in leave_out]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the first in ``order``; rows that tie there are told apart by all their columns.

    Filtering ``row_number`` on 1 makes Spark keep one row per key in every map task before it shuffles,
    so a key that holds a large share of the rows costs no more than the others.
    """
    total = [*(order or []), *row_order(df, leave_out=keys)]
    window = Window.partitionBy(*keys).orderBy(*(total or [F.lit(0)]))
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


def keep_last_added(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Upsert: of equal keys the row of the later table wins."""
    ranked = [t.withColumn("_layer", F.lit(-i)) for i, t in enumerate(tables)]
    stacked = ranked[0]
    for table in ranked[1:]:
        stacked = stacked.unionByName(table)
    return keep_first(stacked, keys, [F.col("_layer").asc()]).drop("_layer")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def assert_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    broken = repeated_keys(df, keys).limit(1).count()
    if broken:
        raise ValueError(f"rows are not unique by {', '.join(keys)}")
    return df
