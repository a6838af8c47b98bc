"""Reports on the published table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from adjudica.operators.counts import distinct_per_group, exact_median, members
from adjudica.operators.dedup import keep_first
from adjudica.operators.joins import null_safe_left
from adjudica.operators.ordered import LAST, placed, running
from adjudica.session import materialise

# First reported year and the address of a data set's page.
FIRST_YEAR = 2018
DATASET_PAGE = "https://www.data.gouv.fr/datasets/"
MERGED_SOURCE = "decp_minef"


def current_records(df: DataFrame, key: str = "uid", current: str = "donneesActuelles") -> DataFrame:
    """One current row per record."""
    return keep_first(df.where(F.col(current)), [key])


def whole(c: Column) -> Column:
    """Amounts cut to whole units; nothing counts as 0."""
    return F.coalesce(c, F.lit(0)).cast("bigint")


def yearly_stats(df: DataFrame, current: DataFrame, as_of: date, first_year: int = FIRST_YEAR) -> DataFrame:
    """Publications, awards, amounts, buyers and holders per year, with a row for every year up to ``as_of``."""
    spark = df.sparkSession
    years = spark.range(first_year, as_of.year + 1).select(F.col("id").cast("int").alias("annee"))
    # Each record counts in its year of publication and in its year of award; one pass over the records finds both.
    figures = F.explode(F.array(*[
        F.struct(F.year(day).alias("annee"), F.lit(award).alias("award"))
        for day, award in (("datePublicationDonnees", False), ("dateNotification", True))
    ])).alias("figure")
    counted = current.select(figures, "montant", "acheteur_id").select("figure.*", "montant", "acheteur_id").groupBy("annee").agg(
        F.count(F.when(~F.col("award"), 1)).alias("nb_publications_marches"),
        F.count(F.when(F.col("award"), 1)).alias("nb_notifications_marches"),
        F.sum(F.when(F.col("award"), F.col("montant").cast("decimal(38,6)"))).alias("_sum"),
        F.countDistinct(F.when(F.col("award"), F.struct("acheteur_id"))).alias("nb_acheteurs_uniques"),
    )
    awarded = current.select(F.year("dateNotification").alias("annee"), "montant")
    medians = exact_median(awarded, ["annee"], "montant", "_median")
    holders = df.groupBy(F.year("dateNotification").alias("annee")).agg(
        members("titulaire_id").alias("nb_titulaires_uniques")
    )
    joined = years
    for part in (counted, medians, holders):
        joined = joined.join(part, "annee", "left")
    happened = F.col("nb_notifications_marches") > 0
    return joined.select(
        "annee",
        F.coalesce("nb_publications_marches", F.lit(0)).alias("nb_publications_marches"),
        F.coalesce("nb_notifications_marches", F.lit(0)).alias("nb_notifications_marches"),
        F.when(happened, whole(F.col("_sum"))).alias("somme_montant_marches_notifies"),
        F.when(happened, whole(F.col("_median"))).alias("mediane_montant_marches_notifies"),
        F.when(happened, F.col("nb_acheteurs_uniques")).alias("nb_acheteurs_uniques"),
        F.when(happened, F.col("nb_titulaires_uniques")).alias("nb_titulaires_uniques"),
    )


def overall_stats(df: DataFrame, current: DataFrame) -> DataFrame:
    """Totals in one row. Buyers and holders are counted without one member, which stands for the null."""
    rows = df.agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        (members("titulaire_id", "titulaire_typeIdentifiant") - 1).alias("nb_titulaires_uniques"),
    )
    records = current.agg(
        members("sourceFile").alias("nb_resources"),
        F.array_sort(F.collect_set("sourceDataset")).alias("sources"),
        F.count(F.lit(1)).alias("nb_marches"),
        (members("acheteur_id") - 1).alias("nb_acheteurs_uniques"),
    )
    return records.withColumns(
        {
            "nb_lignes": rows.select("nb_lignes").scalar(),
            "nb_titulaires_uniques": rows.select("nb_titulaires_uniques").scalar(),
            "colonnes_triees": F.array(*[F.lit(c) for c in sorted(df.columns)]),
            "nb_colonnes": F.lit(len(df.columns)),
        }
    )


def contract_stats(df: DataFrame, as_of: date, first_year: int = FIRST_YEAR) -> DataFrame:
    """The statistics document: totals and one object per year, in one row."""
    # Written once: totals, publications, awards and medians each read it.
    current = materialise(
        current_records(
            df.select(
                "uid",
                "acheteur_id",
                "dateNotification",
                "datePublicationDonnees",
                "montant",
                "donneesActuelles",
                "sourceDataset",
                "sourceFile",
            )
        ),
        "current",
    )
    by_year = yearly_stats(df, current, as_of, first_year)
    figures = [c for c in by_year.columns if c != "annee"]
    years = range(first_year, as_of.year + 1)
    per_year = [F.max(F.when(F.col("annee") == y, F.struct(*figures))).alias(str(y)) for y in years]
    # All years in one struct, so that the yearly figures are worked out once.
    whole_table = overall_stats(df, current).withColumn("_years", by_year.agg(F.struct(*per_year).alias("years")).scalar())
    return whole_table.select(
        *[c for c in whole_table.columns if c != "_years"], F.lit(as_of.isoformat()).alias("date"), "_years.*"
    )


def fill_from_entry_before(df: DataFrame, entries: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fill nulls from the entry of a reference table with the greatest key not above the row's own.

    Entries and rows are put in one order, dealt by ranges of the key, along which the entries' values go forward; so
    neither table is ever in one place, and no row searches the other. A row without a key takes nothing.
    """
    known = entries.where(F.col(key).isNotNull()).select(F.col(key), F.lit(0).alias("_row"), *[F.col(c).alias(f"_entry_{c}") for c in columns])
    both = known.unionByName(df.withColumn("_row", F.lit(1)), allowMissingColumns=True).withColumn("_all", F.lit(0))
    order = [F.col("_all"), F.col(key).asc_nulls_first(), "_row", *[F.col(f"`{c}`") for c in sorted(df.columns) if c != key]]
    filled = running(placed(both, order, "entries"), ["_all"], {f"_last_{c}": (LAST, F.col(f"_entry_{c}")) for c in columns})
    return filled.where("_row = 1").select(
        *[F.coalesce(F.col(c), F.col(f"_last_{c}")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns]
    )


def source_stats(
    current: DataFrame, registry: DataFrame, overlap: DataFrame, merged: str = MERGED_SOURCE, page: str = DATASET_PAGE
) -> DataFrame:
    """Records and buyers per source, with the source's name and the share of records only it has.

    ``registry`` has id, name, owner_org_name and code; ``overlap`` one row per source with ``unique``.
    Sources without an entry of their own take the entry before them in code order.
    """
    entries = registry.select(
        "code",
        F.col("name").alias("nom"),
        F.col("owner_org_name").alias("organisation"),
        F.concat(F.lit(page), F.col("id")).alias("url"),
    )
    buyers = distinct_per_group(current, "sourceDataset", "acheteur_id", "nb_acheteurs")
    kept = distinct_per_group(current, "sourceDataset", "uid", "nb_marchés")
    counted = (
        entries.join(buyers.withColumnRenamed("sourceDataset", "code"), "code", "full")
        .join(kept.withColumnRenamed("sourceDataset", "code"), "code", "full")
        .join(overlap.select(F.col("sourceDataset").alias("code"), "unique"), "code")
    )
    # Only entries whose source appears in the data are in the ordered list.
    present = entries.join(overlap.select(F.col("sourceDataset").alias("code")), "code", "left_semi")
    filled = fill_from_entry_before(counted, present, "code", ["nom", "organisation", "url"])
    return (
        filled.where(F.col("code") != merged)
        .select("nom", "organisation", "url", "nb_marchés", "nb_acheteurs", "code", "unique")
        .fillna(0, subset=["nb_marchés", "nb_acheteurs", "unique"])
        .orderBy(F.col("nb_marchés").desc_nulls_last(), "code")
    )


def totals(df: DataFrame) -> DataFrame:
    """Sum, records, rows, buyers and holders of the current versions."""
    current = df.where(F.col("donneesActuelles"))
    records = keep_first(current.select("uid", "montant", "acheteur_id"), ["uid"])
    rows = current.agg(F.count(F.lit(1)).alias("n_rows"), members("titulaire_id").alias("n_holders"))
    return records.agg(
        whole(F.sum(F.col("montant").cast("decimal(38,6)"))).alias("amount"),
        F.count(F.lit(1)).alias("n_records"),
        members("acheteur_id").alias("n_buyers"),
    ).withColumns({c: rows.select(c).scalar() for c in ("n_rows", "n_holders")})


def records_per_source(df: DataFrame) -> DataFrame:
    """Distinct records per source, the largest first."""
    return distinct_per_group(df, "sourceDataset", "uid", "n_records").orderBy(F.col("n_records").desc(), "sourceDataset")


def resource_profile(df: DataFrame, resource: str, metadata: DataFrame | None = None) -> DataFrame:
    """Rows per resource and the fields that hold a value there; metadata is joined by resource."""
    fields = [c for c in df.columns if c != resource]
    filled = df.groupBy(resource).agg(
        F.count(F.lit(1)).alias("row_number"), *[F.count(F.col(f"`{c}`")).alias(c) for c in fields]
    )
    names = F.filter(F.array(*[F.when(F.col(f"`{c}`") > 0, F.lit(c)) for c in sorted(fields)]), lambda n: n.isNotNull())
    profile = filled.select(
        resource, "row_number", names.alias("data_fields"), F.size(names).cast("bigint").alias("data_fields_number")
    )
    return null_safe_left(profile, metadata, [resource]) if metadata is not None else profile
