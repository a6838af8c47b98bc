from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from adjudica.functions import nested
from adjudica.plans import cleaning

AS_OF = date(2024, 1, 1)


def test_sentinels_are_named_no_object(frame):
    df = frame(
        "considerationsSociales string, considerationsEnvironnementales string, ccag string, typeGroupement string, other string",
        ("Pas de considération sociale", "Pas de considération environnementale", "Pas de CCAG", "Pas de groupement", "Pas de CCAG"),
        ("Oui", "Oui", "CCAG Travaux", "Conjoint", "B"),
    )
    got = [tuple(r) for r in cleaning.name_no_object(df).collect()]
    assert got == [("Sans objet",) * 4 + ("Pas de CCAG",), ("Oui", "Oui", "CCAG Travaux", "Conjoint", "B")]


def test_types_are_repaired(frame):
    df = frame(
        "dureeMois string, montant string, dateNotification string, sousTraitanceDeclaree string, marcheInnovant string,"
        "attributionAvance string, offresRecues string, tauxAvance string, origineFrance string, origineUE string, datePublicationDonnees string",
        ("12", "100.50", "2023-01-01", "true", "1", "true", "1", "0", "0.7", "0", "2023-01-01"),
        ("invalid", "invalid", "invalid-date", "false", "0", "false", "2", "x", "0", "0", "2999-01-01"),
    )
    typed = cleaning.typed(df, AS_OF)
    kinds = dict(typed.dtypes)
    assert (kinds["dureeMois"], kinds["montant"], kinds["tauxAvance"], kinds["dateNotification"]) == ("smallint", "double", "float", "date")
    first, second = typed.collect()
    assert (first.dureeMois, first.montant, first.dateNotification, first.sousTraitanceDeclaree) == (12, 100.5, date(2023, 1, 1), True)
    assert (second.dureeMois, second.montant, second.dateNotification, second.marcheInnovant) == (None, None, None, False)
    assert (second.tauxAvance, second.datePublicationDonnees) == (None, None)


def test_whole_chain(frame):
    holder = f"titulaires {nested.HOLDERS['2019']}, modification_titulaires {nested.HOLDERS['2019']}"
    df = frame(
        "id string, acheteur_id string, `acheteur.id` string, objet string, montant string, datePublicationDonnees string,"
        "dateNotification string, nature string, codeCPV string," + holder + ", modification_id int,"
        "considerationsSociales_considerationSociale array<string>, considerationsSociales array<string>, dureeMois string,"
        "offresRecues string, tauxAvance string, origineFrance string, origineUE string, sousTraitanceDeclaree string,"
        "attributionAvance string, marcheInnovant string, considerationsEnvironnementales array<string>, ccag string, typeGroupement string",
        ("id.1", "ach1", "", "Avec des 'apo'strophe's", "1000", "2023-01-01", "2023-01-01", "Marche subsequent", "123456780-1",
         [{"id": "t1", "typeIdentifiant": "SIRET"}], None, None, ["Clause sociale", "Critère social"], [], "12", "1", "0", "0", "0",
         "false", "false", "false", ["Pas de considération environnementale"], "Pas de CCAG", "Pas de groupement"),
        ("id/2", None, "ach2", "NC", "1000000000000.00", "0002-11-30", "2023-01-01+01:00", "", "876541",
         [{"id": "  12345678901234", "typeIdentifiant": None}, {"id": "t3", "typeIdentifiant": "TVA"}], None, None, ["Critère social"], [],
         "NC", "2", "0", "0", "0", "false", "false", "false", ["Clause environnementale"], "CCAG", "Solidaire"),
        ("", "", "", "x", "2000", "2023-01-02", "2023-01-01", "Autre", "11111111111", [], None, None, [""], [], "36", "3", "0", "0", "0",
         "false", "false", "false", [""], "", ""),
    )
    got = cleaning.clean(df, "2019", AS_OF)
    assert "acheteur.id" not in got.columns and "considerationsSociales_considerationSociale" not in got.columns
    shown = got.select("uid", "titulaire_id", "titulaire_typeIdentifiant", "montant", "dureeMois", "nature", "codeCPV", "objet")
    assert rows(shown) == [
        ("ach1id_1", "t1", "SIRET", 1000.0, 12, "Marché subséquent", "12345678", "Avec des 'apo’strophe’s"),
        ("ach2id_2", "12345678901234", "SIRET", 12311111111.0, None, None, "87654100", None),
        ("ach2id_2", "t3", "TVA", 12311111111.0, None, None, "87654100", None),
    ]
    first = got.where("uid = 'ach1id_1'").first()
    assert first.considerationsSociales == "Clause sociale, Critère social"
    assert (first.considerationsEnvironnementales, first.ccag, first.typeGroupement) == ("Sans objet",) * 3
    second = got.where("uid = 'ach2id_2'").first()
    assert (second.dateNotification, second.datePublicationDonnees) == (date(2023, 1, 1), None)


def test_record_without_holders_keeps_one_row(frame):
    df = frame(f"id string, acheteur_id string, titulaires {nested.HOLDERS['2022']}", ("1", "b", []), ("2", "b", None))
    spread = cleaning.spread_holders(cleaning.clean_holders(df, "2022"))
    assert rows(spread, "id", "titulaire_id") == [("1", None), ("2", None)]


def test_versions_are_ordered_by_date_text_before_dates_are_repaired(frame):
    """Amendments come first, so a date that is repaired later keeps its place as written."""
    df = frame(
        f"id string, acheteur_id string, dateNotification string, datePublicationDonnees string, montant string, dureeMois string,"
        f"titulaires {nested.HOLDERS['2022']}, nature string, codeCPV string, objet string, modification_dateNotificationModification string, modification_montant string",
        ("1", "b", "2023-01-01", None, "10", None, None, None, None, None, None, None),
        ("1", "b", "2023-01-01", None, "10", None, None, None, None, None, "0222-04-29", None),
    )
    got = cleaning.clean(df.withColumn("modification_titulaires", F.col("titulaires")), "2022", AS_OF)
    assert rows(got, "dateNotification", "montant") == [(date(2022, 4, 29), None), (date(2023, 1, 1), 10.0)]
