"""Stacking tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def stack_diagonal(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column that a table lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def append_as(first: DataFrame, second: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Append a second table whose columns are named differently: target name -> source name."""
    return first.unionByName(second.select(*[F.col(mapping.get(c, c)).alias(c) for c in first.columns]))


def stacked_values(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Values of several columns of one table in one column, read in a single pass."""
    return df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias(name))
