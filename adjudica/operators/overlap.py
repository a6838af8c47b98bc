"""How far sources share their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def source_sets(df: DataFrame, key: str = "uid", source: str = "sourceDataset") -> DataFrame:
    """Which set of sources holds a key, and how many keys each such set has.

    A key's set is no larger than the list of sources, and the result has one row per set that occurs.
    Rows without a source count under the name ``null``.
    """
    named = F.coalesce(F.col(source).cast("string"), F.lit("null"))
    per_key = df.groupBy(key).agg(F.array_sort(F.collect_set(named)).alias("sources"))
    return per_key.groupBy("sources").agg(F.count(F.lit(1)).alias("n_keys"))


def overlap_pairs(df: DataFrame, key: str = "uid", source: str = "sourceDataset") -> DataFrame:
    """Long form: for each source, the share of its keys held by each source it meets.

    The row of a source with itself has the share of keys that no other source holds, in ``unique``.
    Pairs are formed once per set of sources, never per key.
    """
    sets = source_sets(df, key, source).withColumn("alone", F.size("sources") == 1)
    one = sets.select("sources", "n_keys", "alone", F.explode("sources").alias(source))
    totals = one.groupBy(source).agg(
        F.sum("n_keys").alias("n_total"),
        F.coalesce(F.sum(F.when(F.col("alone"), F.col("n_keys"))), F.lit(0)).alias("n_alone"),
    )
    met = (
        one.select(source, "n_keys", F.explode("sources").alias("other"))
        .groupBy(source, "other")
        .agg(F.sum("n_keys").alias("n_both"))
    )
    return met.join(totals, source).select(
        source,
        "other",
        "n_both",
        "n_total",
        (F.col("n_both") / F.col("n_total")).alias("share"),
        (F.col("n_alone") / F.col("n_total")).alias("unique"),
    )


def overlap_matrix(
    df: DataFrame, sources: Sequence[str], key: str = "uid", source: str = "sourceDataset"
) -> DataFrame:
    """Wide form: one row per source, one column per source; null on the diagonal, 0 where they never meet."""
    pairs = overlap_pairs(df, key, source)
    names = list(sources)
    wide = pairs.groupBy(source).agg(
        F.max("unique").alias("unique"),
        *[F.coalesce(F.max(F.when(F.col("other") == s, F.col("share"))), F.lit(0.0)).alias(s) for s in names],
    )
    return wide.withColumns({s: F.when(F.col(source) != s, F.col(s)) for s in names})


def overlap_matrix_found(df: DataFrame, key: str = "uid", source: str = "sourceDataset") -> DataFrame:
    """Wide form with the sources found in the data; Spark looks them up for the pivot."""
    pairs = overlap_pairs(df, key, source)
    apart = pairs.withColumn("share", F.when(F.col("other") != F.col(source), F.col("share")))
    wide = apart.groupBy(source, "unique").pivot("other").agg(F.max("share"))
    others = [c for c in wide.columns if c not in (source, "unique")]
    return wide.withColumns({c: F.when(F.col(source) != c, F.coalesce(F.col(f"`{c}`"), F.lit(0.0))) for c in others})


def sources_per_key(df: DataFrame, key: str = "uid", source: str = "sourceDataset") -> DataFrame:
    """Number of sources that hold a key."""
    return df.groupBy(key).agg(F.countDistinct(source).alias("n_sources"))
