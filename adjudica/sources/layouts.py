"""Column layouts of the records, before and after cleaning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

# Field names of the two published layouts.
PLAIN_FIELDS = [
    "procedure",
    "nature",
    "codeCPV",
    "dureeMois",
    "datePublicationDonnees",
    "id",
    "formePrix",
    "dateNotification",
    "objet",
    "montant",
    "source",
    "uid",
    "marcheInnovant",
    "attributionAvance",
    "sousTraitanceDeclaree",
    "ccag",
    "offresRecues",
    "typeGroupementOperateurs",
    "idAccordCadre",
    "tauxAvance",
    "origineUE",
    "origineFrance",
]
LIST_FIELDS = {
    "considerationsSociales": "considerationSociale",
    "considerationsEnvironnementales": "considerationEnvironnementale",
    "modalitesExecution": "modaliteExecution",
    "techniques": "technique",
    "typesPrix": "typePrix",
}
BLOCKS = ["titulaires", "modifications"]


@dataclass(frozen=True)
class Layout:
    """A record layout and the path of its records in a document."""

    name: str
    path: tuple[str, ...]


LAYOUTS = {"2019": Layout("2019", ("marches",)), "2022": Layout("2022", ("marches", "marche"))}


def _text(names) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


# A record as read. Blocks and list fields stay JSON text: their shape differs by layout and by sender.
RECORD = StructType(
    _text(PLAIN_FIELDS)
    + [
        StructField("acheteur.id", StringType()),
        StructField("acheteur", StructType(_text(["id"]))),
        StructField("lieuExecution", StructType(_text(["code", "typeCode"]))),
    ]
    + _text([*LIST_FIELDS, *BLOCKS])
)

# Name, title and type of the published columns, in order.
_S, _D, _F, _I, _B, _T = StringType(), DoubleType(), FloatType(), ShortType(), BooleanType(), DateType()
CONTRACT: list[tuple[str, str, DataType]] = [
    ("uid", "Identifiant unique", _S),
    ("id", "Identifiant interne", _S),
    ("nature", "Nature", _S),
    ("acheteur_id", "SIRET acheteur", _S),
    ("acheteur_nom", "Nom acheteur", _S),
    ("titulaire_id", "Identifiant titulaire", _S),
    ("titulaire_typeIdentifiant", "Type identifiant", _S),
    ("titulaire_nom", "Nom titulaire", _S),
    ("objet", "Objet", _S),
    ("montant", "Montant attribué", _D),
    ("type", "Type", _S),
    ("codeCPV", "Code CPV", _S),
    ("procedure", "Procédure", _S),
    ("techniques", "Techniques", _S),
    ("dureeMois", "Durée (mois)", _I),
    ("dureeRestanteMois", "Durée restante (mois)", _D),
    ("offresRecues", "Offres reçues", _I),
    ("dateNotification", "Date notification", _T),
    ("datePublicationDonnees", "Date publication données", _T),
    ("formePrix", "Forme prix", _S),
    ("typesPrix", "Types prix", _S),
    ("attributionAvance", "Attribution avance", _B),
    ("tauxAvance", "Taux avance", _F),
    ("marcheInnovant", "Marché innovant", _B),
    ("modalitesExecution", "Modalités exécution", _S),
    ("considerationsSociales", "Considérations sociales", _S),
    ("considerationsEnvironnementales", "Considérations environnementales", _S),
    ("ccag", "CCAG", _S),
    ("sousTraitanceDeclaree", "Sous-traitance déclarée", _B),
    ("typeGroupementOperateurs", "Type groupement", _S),
    ("origineUE", "Origine UE", _F),
    ("origineFrance", "Origine France", _F),
    ("lieuExecution_code", "Code lieu exécution", _S),
    ("lieuExecution_typeCode", "Type code lieu exécution", _S),
    ("idAccordCadre", "Identifiant accord-cadre", _S),
    ("titulaire_distance", "Distance acheteur-titulaire", _I),
    ("acheteur_categorie", "Catégorie de l'acheteur", _S),
    ("acheteur_commune_code", "Commune de l'acheteur (code)", _S),
    ("acheteur_commune_nom", "Commune de l'acheteur", _S),
    ("acheteur_departement_code", "Département de l'acheteur (code)", _S),
    ("acheteur_departement_nom", "Département de l'acheteur", _S),
    ("acheteur_region_code", "Région de l'acheteur (code)", _S),
    ("acheteur_region_nom", "Région de l'acheteur", _S),
    ("acheteur_latitude", "Latitude de l'acheteur", _D),
    ("acheteur_longitude", "Longitude de l'acheteur", _D),
    ("titulaire_categorie", "Catégorie du titulaire", _S),
    ("titulaire_commune_code", "Commune du titulaire (code)", _S),
    ("titulaire_commune_nom", "Commune du titulaire", _S),
    ("titulaire_departement_code", "Département du titulaire (code)", _S),
    ("titulaire_departement_nom", "Département du titulaire", _S),
    ("titulaire_region_code", "Région du titulaire (code)", _S),
    ("titulaire_region_nom", "Région du titulaire", _S),
    ("titulaire_latitude", "Latitude du titulaire", _D),
    ("titulaire_longitude", "Longitude du titulaire", _D),
    ("modification_id", "Identifiant modification", _I),
    ("donneesActuelles", "Données actuelles", _B),
    ("sourceDataset", "Source dataset", _S),
    ("sourceFile", "Source fichier", _S),
]
# Columns that the published description declares otherwise than they are stored.
DECLARED_TYPES = {"acheteur_id": "integer", "titulaire_id": "integer", "lieuExecution_code": "integer"}
CONTRACT_COLUMNS = [name for name, _, _ in CONTRACT]


def contract_schema() -> StructType:
    return StructType([StructField(n, t, metadata={"title": title}) for n, title, t in CONTRACT])


GEOCODE_CACHE = "siret string, latitude double, longitude double, source string, score double, geocoded_at date, status string"
GEOCODE_REPLY = "siret string, result_score double, latitude double, longitude double"
