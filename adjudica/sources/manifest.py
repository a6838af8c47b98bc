"""The list of data sets and resources to take in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.operators.dedup import keep_first

RESOURCE = ("dataset_id", "id")
# Formats taken, sizes and fallbacks of the published selection.
FORMATS = ("json", "xml")
SMALLEST_BYTES = 180
UNKNOWN_BYTES = 1000


def tracked(datasets: DataFrame, only: Sequence[str] = ()) -> DataFrame:
    """Data sets to take: the given ones, or all that are neither skipped nor deleted."""
    if only:
        return datasets.where(F.col("id").isin(*only))
    kept = datasets
    if "skip" in datasets.columns:
        kept = kept.where(~F.coalesce(F.col("skip"), F.lit(False)))
    if "deleted_date" in datasets.columns:
        kept = kept.where(F.col("deleted_date").isNull())
    return kept


def resources(listed: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """One row per resource to read, from one row per data set and resource.

    Columns in: dataset_id, dataset_name, dataset_code, id, title, format, url, created_at, last_modified,
    checksum, analysis_checksum, filesize, analysis_filesize, views.
    """
    kept = listed.where(F.col("format").isin(*FORMATS))
    if excluded:
        kept = kept.where(~F.col("id").isin(*excluded))
    size = F.coalesce(
        F.nullif(F.col("filesize"), F.lit(0)), F.nullif(F.col("analysis_filesize"), F.lit(0)), F.lit(UNKNOWN_BYTES)
    )
    stem = F.replace(F.lower("title"), F.lit(".json"), F.lit(""))
    stem = F.replace(F.replace(stem, F.lit(".xml"), F.lit("")), F.lit("."), F.lit("_"))
    return kept.select(
        "dataset_id",
        "dataset_name",
        "dataset_code",
        "id",
        F.col("title").alias("ori_filename"),
        F.coalesce("checksum", F.nullif(F.col("analysis_checksum"), F.lit("")), "id").alias("checksum"),
        F.concat_ws("_", "dataset_id", stem, F.substring("id", 1, 3)).alias("filename"),
        "url",
        "format",
        "created_at",
        "last_modified",
        size.alias("filesize"),
        "views",
    )


def large_enough(manifest: DataFrame, smallest: int = SMALLEST_BYTES) -> DataFrame:
    return manifest.where(F.col("filesize") > smallest)


def not_yet_ingested(manifest: DataFrame, done: DataFrame, key: str | Sequence[str] = "checksum") -> DataFrame:
    """Resources whose content has not been taken in before."""
    keys = [key] if isinstance(key, str) else list(key)
    return manifest.join(done.select(*keys).distinct(), keys, "left_anti")


def current(listed: DataFrame) -> DataFrame:
    """The valid content of every resource that is listed now: one checksum each.

    Where a list has several states of a resource, the one modified last is valid, of equal ones the one created last.
    Files that are too small don't count, as they aren't taken in.
    """
    known = large_enough(listed)
    latest = [F.col(c).desc_nulls_last() for c in ("last_modified", "created_at") if c in listed.columns]
    return keep_first(known, list(RESOURCE), latest)


def only_current(cleaned: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows of content that is valid now; what was replaced or withdrawn is neither kept nor read.

    ``cleaned`` has the columns ``resource`` and ``checksum``, which are folders where it was written by ``ingest``. The
    list is small beside it, so folders of other content are pruned while the query runs.
    """
    valid = current(listed).select(resource_key().alias("resource"), "checksum").where("checksum is not null")
    return cleaned.join(valid, ["resource", "checksum"], "left_semi")


def resource_key() -> Column:
    """What tells resources apart: a file may be listed in several data sets."""
    return F.concat_ws(":", *RESOURCE)
