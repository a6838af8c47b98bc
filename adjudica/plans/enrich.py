"""Enrichment of records with company and site data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from adjudica.functions.geo import whole_km
from adjudica.functions.rules import buyer_category, contract_type, with_site_name
from adjudica.functions.typing import remaining_months
from adjudica.operators.columns import ending_with, starting_with
from adjudica.operators.joins import filled_from_literals

# A buyer that the registers do not list, and address columns not to be published.
UNLISTED_BUYERS = {"13001536500013": "Ministère des Armées"}
PLACE = [
    "latitude",
    "longitude",
    "commune_code",
    "commune_nom",
    "departement_code",
    "departement_nom",
    "region_code",
    "region_nom",
]
ADDRESS = [
    "libelleVoieEtablissement",
    "typeVoieEtablissement",
    "numeroVoieEtablissement",
    "indiceRepetitionEtablissement",
    "codePostalEtablissement",
    "libelleCommuneEtablissement",
]
CACHE_DETAILS = ["geocoded_at", "score", "source", "status"]


def enrich_company(ids: DataFrame, companies: DataFrame, id_column: str, role: str) -> DataFrame:
    """Company name and category by the first nine characters of the id; unknown ids go."""
    found = ids.withColumn("siren", F.substring(id_column, 1, 9)).join(companies, "siren")
    named = found.withColumnsRenamed(
        {
            "denominationUniteLegale": f"{role}_nom",
            "siren": f"{role}_siren",
            "categorieEntreprise": f"{role}_categorie",
        }
    )
    if role == "acheteur":
        category = buyer_category(F.col("categorieJuridiqueUniteLegale"), F.col(id_column))
        named = named.withColumn(f"{role}_categorie", category)
    return named.drop("categorieJuridiqueUniteLegale")


def enrich_site(ids: DataFrame, sites: DataFrame, id_column: str, role: str) -> DataFrame:
    """Place, activity and site name by the whole id; unknown ids go."""
    found = ids.join(sites.withColumnRenamed("siret", id_column), id_column)
    if role == "acheteur":
        found = found.drop(*starting_with(found, "activite_"))
    name = f"{role}_nom"
    return (
        found.withColumn(name, with_site_name(F.col(name), F.col("etablissement_nom")))
        .drop("etablissement_nom", *ADDRESS, *CACHE_DETAILS)
        .withColumnsRenamed({c: f"{role}_{c}" for c in PLACE})
    )


def distinct_buyers(df: DataFrame) -> DataFrame:
    return df.select("acheteur_id").distinct()


def distinct_holders(df: DataFrame) -> DataFrame:
    """Distinct holder ids that are site numbers."""
    ids = df.select("titulaire_id", "titulaire_typeIdentifiant").distinct()
    return ids.where((F.col("titulaire_id") != "") & (F.col("titulaire_typeIdentifiant") == "SIRET"))


def with_distance(df: DataFrame) -> DataFrame:
    points = [F.col(f"{role}_{axis}") for role in ("acheteur", "titulaire") for axis in ("latitude", "longitude")]
    return df.withColumn("titulaire_distance", whole_km(*points))


def enrich(
    df: DataFrame, companies: DataFrame, sites: DataFrame, fallback: dict[str, str] | None = None
) -> DataFrame:
    """Buyer and holder data on every row.

    Registers are joined to the distinct ids first, so they meet each id once however often it occurs.
    """
    buyers = enrich_site(
        enrich_company(distinct_buyers(df), companies, "acheteur_id", "acheteur"), sites, "acheteur_id", "acheteur"
    )
    holders = enrich_site(
        enrich_company(distinct_holders(df), companies, "titulaire_id", "titulaire"), sites, "titulaire_id", "titulaire"
    )
    named = filled_from_literals(
        df.join(buyers, "acheteur_id", "left"),
        "acheteur_id",
        "acheteur_nom",
        UNLISTED_BUYERS if fallback is None else fallback,
    )
    both = named.join(holders, ["titulaire_id", "titulaire_typeIdentifiant"], "left")
    return with_distance(both).drop(*ending_with(both, "_siren"))


def derive(df: DataFrame, as_of: date) -> DataFrame:
    """Months left and type of contract."""
    return df.withColumns(
        {
            "dureeRestanteMois": remaining_months(F.col("dateNotification"), F.col("dureeMois"), as_of),
            "type": contract_type(F.col("codeCPV")),
        }
    )
