"""Company, site and geographic registers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adjudica.functions.rules import company_name
from adjudica.functions.text import pad_left
from adjudica.operators.sets import append_as, stacked_values
from adjudica.operators.dedup import keep_first


def prepare_companies(df: DataFrame) -> DataFrame:
    """Companies with their display name, category and legal form."""
    name = company_name(
        F.col("denominationUniteLegale"),
        F.col("prenomUsuelUniteLegale"),
        F.col("nomUniteLegale"),
        F.col("nomUsageUniteLegale"),
        F.col("statutDiffusionUniteLegale"),
    )
    used = [
        "siren",
        "denominationUniteLegale",
        "prenomUsuelUniteLegale",
        "nomUniteLegale",
        "nomUsageUniteLegale",
        "statutDiffusionUniteLegale",
        "categorieEntreprise",
        "categorieJuridiqueUniteLegale",
    ]
    return (
        df.select(*used)
        .where(F.col("siren").isNotNull())
        .distinct()
        .select("siren", name.alias("denominationUniteLegale"), "categorieEntreprise", "categorieJuridiqueUniteLegale")
    )


def prepare_sites(df: DataFrame, geo: DataFrame) -> DataFrame:
    """Sites with padded codes, one name and the names of their municipality."""
    sites = df.withColumns(
        {
            "codeCommuneEtablissement": pad_left(F.col("codeCommuneEtablissement"), 5),
            "siret": pad_left(F.col("siret"), 14),
            "etablissement_nom": F.coalesce("enseigne1Etablissement", "denominationUsuelleEtablissement"),
        }
    ).drop("denominationUsuelleEtablissement", "enseigne1Etablissement")
    renamed = sites.withColumnsRenamed(
        {
            "codeCommuneEtablissement": "commune_code",
            "activitePrincipaleEtablissement": "activite_code",
            "nomenclatureActivitePrincipaleEtablissement": "activite_nomenclature",
        }
    )
    return renamed.join(geo, "commune_code", "left")


def build_geo_register(
    communes: DataFrame,
    overseas_communes: DataFrame,
    departments: DataFrame,
    overseas_departments: DataFrame,
    regions: DataFrame,
) -> DataFrame:
    """Municipalities with department and region; overseas territories stand in for both.

    Columns in: COM, LIBELLE, REG, DEP; COM_COMER, LIBELLE, COMER; DEP, LIBELLE; COMER, LIBELLE; REG, LIBELLE.
    """
    all_communes = append_as(
        communes.select("COM", "LIBELLE", "REG", "DEP"),
        overseas_communes,
        {"COM": "COM_COMER", "DEP": "COMER", "REG": "COMER"},
    ).where(F.col("DEP") != "")
    all_departments = append_as(departments.select("DEP", "LIBELLE"), overseas_departments, {"DEP": "COMER"})
    all_regions = append_as(regions.select("REG", "LIBELLE"), overseas_departments, {"REG": "COMER"})
    return (
        all_communes.withColumnRenamed("LIBELLE", "commune_nom")
        .join(all_departments.withColumnRenamed("LIBELLE", "departement_nom"), "DEP", "left")
        .join(all_regions.withColumnRenamed("LIBELLE", "region_nom"), "REG", "left")
        .withColumnsRenamed({"COM": "commune_code", "DEP": "departement_code", "REG": "region_code"})
        .orderBy("commune_code")
    )


def sites_with_coordinates(sites: DataFrame, cache: DataFrame) -> DataFrame:
    return sites.join(cache, "siret", "left")


def seed_cache(df: DataFrame) -> DataFrame:
    """Geocode cache from the coordinates of an already published table."""
    located = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.col(f"{role}_id").cast("string").alias("siret"),
                        F.col(f"{role}_latitude").alias("latitude"),
                        F.col(f"{role}_longitude").alias("longitude"),
                        F.lit(i).alias("_role"),
                    )
                    for i, role in enumerate(("acheteur", "titulaire"))
                ]
            )
        ).alias("site")
    ).select("site.*")
    whole = located.where(F.length("siret") == 14).dropna(subset=["latitude", "longitude"])
    return keep_first(whole, ["siret"], [F.col("_role").asc()]).select(
        "siret",
        "latitude",
        "longitude",
        F.lit("decp").alias("source"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("date").alias("geocoded_at"),
        F.lit("success").alias("status"),
    )


def known_ids(df: DataFrame) -> DataFrame:
    """Distinct buyer and holder ids of full length."""
    ids = stacked_values(df, ["acheteur_id", "titulaire_id"], "siret")
    return ids.where(F.length("siret") == 14).distinct()
