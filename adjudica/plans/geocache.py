"""The geocode cache: what to ask for, what came back, what to keep."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.functions.text import address_line
from adjudica.operators.counts import shares
from adjudica.operators.dedup import keep_last_added
from adjudica.plans.registers import known_ids

# Names of the origin and states of a cache entry, and the score that counts as found.
ORIGIN = "geoplateforme"
SUCCESS, FAILED, UNLISTED = "success", "failed", "not_in_sirene"
MIN_SCORE = 0.5
RETRY_DAYS = 30
CACHE_COLUMNS = ["siret", "latitude", "longitude", "source", "score", "geocoded_at", "status"]


def settled(as_of: date, retry_days: int = RETRY_DAYS) -> Column:
    """Entries not to be asked for again: found, unlisted, or failed a short while ago."""
    status = F.col("status")
    recent = F.col("geocoded_at") >= F.lit(as_of - timedelta(days=retry_days))
    return status.isin(SUCCESS, UNLISTED) | ((status == FAILED) & recent)


def select_pending(df: DataFrame, cache: DataFrame, as_of: date, retry_days: int = RETRY_DAYS) -> DataFrame:
    """Ids of the table that still need coordinates."""
    return known_ids(df).join(cache.where(settled(as_of, retry_days)).select("siret"), "siret", "left_anti")


def geocoder_request(pending: DataFrame, sites: DataFrame) -> DataFrame:
    """Addresses to send, for the pending ids that the register lists."""
    street = ["numeroVoieEtablissement", "indiceRepetitionEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement"]
    return pending.join(sites, "siret").select(
        "siret",
        address_line(*[F.col(c) for c in street]).alias("q"),
        F.col("codePostalEtablissement").cast("string").alias("postcode"),
        F.col("commune_code").cast("string").alias("citycode"),
    )


def parse_replies(df: DataFrame, as_of: date, min_score: float = MIN_SCORE) -> DataFrame:
    """Replies to cache entries; below the score the coordinates go."""
    found = F.coalesce(F.col("result_score") >= min_score, F.lit(False))
    return df.select(
        "siret",
        F.when(found, F.col("latitude")).alias("latitude"),
        F.when(found, F.col("longitude")).alias("longitude"),
        F.lit(ORIGIN).alias("source"),
        F.col("result_score").alias("score"),
        F.lit(as_of).alias("geocoded_at"),
        F.when(found, F.lit(SUCCESS)).otherwise(F.lit(FAILED)).alias("status"),
    )


def unlisted(pending: DataFrame, sites: DataFrame, as_of: date) -> DataFrame:
    """Entries for pending ids that the register does not know."""
    nothing = F.lit(None).cast("double")
    return pending.join(sites.select("siret"), "siret", "left_anti").select(
        "siret",
        nothing.alias("latitude"),
        nothing.alias("longitude"),
        F.lit(ORIGIN).alias("source"),
        nothing.alias("score"),
        F.lit(as_of).alias("geocoded_at"),
        F.lit(UNLISTED).alias("status"),
    )


def upsert_cache(
    cache: DataFrame, pending: DataFrame, replies: DataFrame | None, sites: DataFrame, as_of: date
) -> DataFrame:
    """The cache with new entries in place of older ones of the same id; without replies only unlisted ids are new."""
    layers = [cache.select(*CACHE_COLUMNS), unlisted(pending, sites, as_of)]
    if replies is not None:
        asked = replies.join(pending.select("siret"), "siret", "left_semi")
        layers.append(parse_replies(asked.join(sites.select("siret"), "siret", "left_semi"), as_of))
    return keep_last_added(layers, ["siret"])


def reply_report(parsed: DataFrame) -> DataFrame:
    """Replies per status with their share, the most frequent first."""
    return shares(parsed, "status").orderBy(F.col("n").desc(), "status")
