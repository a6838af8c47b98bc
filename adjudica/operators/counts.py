"""Counts, shares and exact medians."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.operators.joins import null_safe_left
from adjudica.operators.ordered import SUM, placed, running


def members(*columns: str | Column) -> Column:
    """Distinct values, the null member included."""
    return F.countDistinct(F.struct(*columns))


def counted(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_per_group(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """Distinct values per group, a null value counted as one."""
    return df.groupBy(group).agg(members(value).alias(name))


def shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per value and their percentage of all rows, one decimal."""
    counts = counted(df, [key], "n")
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") / total * 100, 1))


def exact_median(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Exact interpolating median per group, without holding a group's values in one place.

    The input is read once and counted by value on the map side. The distinct values are dealt by ranges and their counts
    added up along them, so a group of any size spans many tasks, and the value at a middle rank is the one whose sum
    first reaches it. Null values are left out; null keys are a group.
    """
    groups = list(keys) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)).select(*groups, F.col(value).cast("double").alias("_v")).where("_v is not null")
    times = rows.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_times"))
    ordered = placed(times, [F.col(f"`{c}`") for c in (*groups, "_v")], "values")
    # One row per group, which Spark finds out by its size.
    middles = ordered.groupBy(*groups).agg(F.sum("_times").alias("_n"))
    upto = null_safe_left(running(ordered, groups, {"_upto": (SUM, F.col("_times"))}), middles, groups)

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_times") < rank), F.col("_v")))

    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    return upto.groupBy(*groups).agg(((value_at(low) + value_at(high)) / 2).alias(name)).select(*keys, name)
