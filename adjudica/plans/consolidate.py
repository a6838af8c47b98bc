"""All sources in one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from adjudica.operators.dedup import keep_first
from adjudica.operators.overlap import overlap_pairs
from adjudica.operators.sets import stack
from adjudica.sources.tables import read_parquet

# What makes two rows the same.
ROW_KEY = ("uid", "titulaire_id", "titulaire_typeIdentifiant", "dateNotification")


def consolidate_tables(tables: Sequence[DataFrame], key: Sequence[str] = ROW_KEY) -> DataFrame:
    """Union of the sources with one row per key."""
    return keep_first(stack(tables), list(key))


def consolidate(spark: SparkSession, paths: Sequence[str], key: Sequence[str] = ROW_KEY, schema=None) -> tuple[DataFrame, DataFrame]:
    """Deduplicated union of cleaned files, and how far the sources overlap before that."""
    every = read_parquet(spark, *paths, schema=schema)
    return keep_first(every, list(key)), overlap_pairs(every)
