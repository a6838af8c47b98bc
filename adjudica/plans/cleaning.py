"""The cleaning chain. The order of its steps decides the result."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from adjudica.functions import nested, text, typing
from adjudica.operators.columns import on_columns, require_keys, text_columns, text_list_columns
from adjudica.operators.versions import apply_versions

# Words and columns named by the published rules.
NO_OBJECT = "Sans objet"
MEANS_NO_OBJECT = {
    "considerationsSociales": "Pas de considération sociale",
    "considerationsEnvironnementales": "Pas de considération environnementale",
    "ccag": "Pas de CCAG",
    "typeGroupement": "Pas de groupement",
    "typeGroupementOperateurs": "Pas de groupement",
}
DATE_REPAIRS = {
    "0002-11-30": "",
    "September, 16 2021 00:00:00": "2021-09-16",
    "16 2021 00:00:00": "",
    "0222-04-29": "2022-04-29",
    "0021-12-05": "2022-12-05",
    "0001-06-21": "",
    "0019-10-18": "",
    "5021-02-18": "2021-02-18",
    "2921-11-19": "",
    "0022-04-29": "2022-04-29",
}
LIST_COLUMNS = {
    "considerationsSociales": "considerationsSociales_considerationSociale",
    "considerationsEnvironnementales": "considerationsEnvironnementales_considerationEnvironnementale",
    "techniques": "techniques_technique",
    "typesPrix": "typesPrix_typePrix",
    "modalitesExecution": "modalitesExecution_modaliteExecution",
}
DATES = ["dateNotification", "datePublicationDonnees"]
FLAGS = ["sousTraitanceDeclaree", "attributionAvance", "marcheInnovant"]
WHOLE_NUMBERS = {"dureeMois": "smallint", "offresRecues": "smallint"}
DECIMAL_NUMBERS = {"montant": "double", "tauxAvance": "float", "origineFrance": "float", "origineUE": "float"}


def _present(df: DataFrame, names) -> list[str]:
    return [n for n in names if n in df.columns]


def merge_buyer_id(df: DataFrame) -> DataFrame:
    """The older layout names the buyer in a flat field or in a nested one."""
    if "acheteur.id" not in df.columns:
        return df
    return df.withColumn("acheteur_id", F.coalesce("acheteur_id", "`acheteur.id`")).drop("acheteur.id")


def identify(df: DataFrame) -> DataFrame:
    """Keep records with an id and a buyer, tidy the id and derive the key of the record."""
    kept = require_keys(df, "id", "acheteur_id").withColumn("id", text.tidy_id(F.col("id")))
    return kept.withColumn("uid", F.concat("acheteur_id", "id"))


def clean_holders(df: DataFrame, layout: str) -> DataFrame:
    return on_columns(
        df, _present(df, ["titulaires", "modification_titulaires"]), lambda c: nested.tidy_holders(c, layout)
    )


def spread_holders(df: DataFrame) -> DataFrame:
    """One row per holder; a record without holders keeps one row."""
    return df.select("*", F.inline_outer("titulaires")).drop("titulaires")


def repair_dates(df: DataFrame) -> DataFrame:
    """Known typing errors, then the time zone suffix."""
    return on_columns(df, _present(df, DATES), lambda c: text.before(text.replace_words(c, DATE_REPAIRS), "+"))


def flatten_lists(df: DataFrame) -> DataFrame:
    """Bring list columns under one name and turn them into text."""
    for name, other in LIST_COLUMNS.items():
        if other in df.columns and name in df.columns:
            df = df.withColumn(name, nested.first_filled_list(F.col(name), F.col(other))).drop(other)
        elif other in df.columns:
            df = df.withColumnRenamed(other, name)
    return on_columns(df, text_list_columns(df), nested.list_text)


def name_no_object(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            n: F.when(F.col(n) == MEANS_NO_OBJECT[n], F.lit(NO_OBJECT)).otherwise(F.col(n))
            for n in _present(df, MEANS_NO_OBJECT)
        }
    )


def default_id_type(df: DataFrame) -> DataFrame:
    """A 14-character holder id without a type is a site number."""
    holder, kind = F.col("titulaire_id"), F.col("titulaire_typeIdentifiant")
    return df.withColumn("titulaire_id", text.strip(holder)).withColumn(
        "titulaire_typeIdentifiant", F.when(kind.isNull() & (F.length(holder) == 14), F.lit("SIRET")).otherwise(kind)
    )


def typed(df: DataFrame, as_of: date) -> DataFrame:
    """Text to numbers, dates and flags; dates after ``as_of`` go."""
    changes = {n: typing.whole_number(F.col(n), WHOLE_NUMBERS[n]) for n in _present(df, WHOLE_NUMBERS)}
    changes |= {n: typing.decimal_number(F.col(n), DECIMAL_NUMBERS[n]) for n in _present(df, DECIMAL_NUMBERS)}
    changes |= {n: typing.not_after(typing.iso_date(F.col(n)), as_of) for n in _present(df, DATES)}
    changes |= {n: typing.flag_word(F.col(n)) for n in _present(df, FLAGS)}
    return df.withColumns(changes)


def clean_values(df: DataFrame, as_of: date) -> DataFrame:
    """All steps that work on one row after holders are spread."""
    df = df.withColumn("montant", typing.plausible_amount(F.col("montant")))
    df = repair_dates(df)
    df = df.withColumns(
        {
            "nature": text.replace_words(F.col("nature"), text.NATURE_SPELLING),
            "codeCPV": text.product_code(F.col("codeCPV")),
        }
    )
    df = name_no_object(flatten_lists(df))
    df = default_id_type(on_columns(df, text_columns(df), text.blank_to_null))
    df = on_columns(df, text_columns(df), text.not_communicated_to_null)
    df = df.withColumn("objet", text.typographic_apostrophes(F.col("objet")))
    return typed(df, as_of)


def clean(df: DataFrame, layout: str, as_of: date, within: Sequence[str] = ()) -> DataFrame:
    """Raw flattened records of one layout to typed rows, one per version and holder.

    Amendments belong to the records of the same resource, which ``within`` names.
    """
    if layout == "2019":
        df = merge_buyer_id(df)
    versions = apply_versions(clean_holders(identify(df), layout), [*within, "uid"])
    return clean_values(spread_holders(versions), as_of)
