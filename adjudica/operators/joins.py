"""Equi-joins. Sizes are left to Spark: it broadcasts a side only below its size threshold and splits hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def same(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for l, r in keys:
        condition = condition & left[l].eqNullSafe(right[r])
    return condition


def null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which null keys meet null keys; the right side brings its other columns."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    joined = left.join(named, same(left, named, [(k, f"_r_{k}") for k in keys]), "left")
    return joined.drop(*[f"_r_{k}" for k in keys])


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Left join on keys that are named differently; the right names go."""
    named = right.withColumnsRenamed({r: f"_r_{r}" for _, r in keys})
    condition = [left[l] == named[f"_r_{r}"] for l, r in keys]
    return left.join(named, condition, "left").drop(*[f"_r_{r}" for _, r in keys])


def key_coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of the left table the right one knows, and the share in percent."""
    mine = left.select(key).distinct().where(F.col(key).isNotNull())
    known = right.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        mine.join(known, key, "left")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.count("_known").alias("n_known"))
        .withColumn("pct_known", F.round(F.col("n_known") / F.nullif(F.col("n_keys"), F.lit(0)) * 100, 2))
    )


def filled_from_literals(df: DataFrame, key: str, column: str, values: dict[str, str]) -> DataFrame:
    """Fill a missing value from a fixed table of a few entries, which is broadcast."""
    if not values:
        return df
    rows = [(k, v) for k, v in values.items()]
    fallback = df.sparkSession.createDataFrame(rows, f"{key} string, _fallback string")
    return (
        df.join(F.broadcast(fallback), key, "left")
        .withColumn(column, F.coalesce(column, "_fallback"))
        .drop("_fallback")
    )
