"""Links in web pages and catalogues, and the mapping of one interface's records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Marks of the wanted links and records.
JSON_LINK_TITLE = "Télécharger au format Json"
JSON_PATH = "/json/"
INTERFACE_SOURCE = "scrap_aife_dume"


# Named entities that occur in addresses, and the ampersand in all its spellings.
ENTITIES = {"&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">"}
NUMBERED = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
AMPERSAND = r"&(?:amp|#0{0,5}38|#[xX]0{0,4}26);"
# Not part of a page's elements: comments, also those never closed, and what scripts and styles hold.
UNSEEN = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)"


def _character(entity: Column) -> Column:
    """The character of a numbered entity; the entity itself where the number is none of a character."""
    digits = F.regexp_extract(entity, "([0-9a-fA-F]+);", 1)
    code = F.when(F.lower(entity).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    is_one = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    # Decoded only where there is such a character: four bytes, the highest first.
    safe = F.when(is_one, code).otherwise(F.lit(0))
    return F.when(is_one, F.decode(F.unhex(F.lpad(F.hex(safe.cast("long")), 8, "0")), "UTF-32")).otherwise(entity)


def unescaped(c: Column) -> Column:
    """Text with its entities decoded once, the ampersand last, so ``&amp;lt;`` becomes ``&lt;``."""
    for entity, character in ENTITIES.items():
        c = F.replace(c, F.lit(entity), F.lit(character))
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(NUMBERED), F.lit(0)))
    others = F.filter(found, lambda e: ~F.rlike(e, F.lit(f"^{AMPERSAND}$")))
    c = F.aggregate(others, c, lambda text, e: F.replace(text, e, _character(e)))
    return F.regexp_replace(c, AMPERSAND, "&")


def elements_only(html: Column) -> Column:
    """A page without comments, scripts and styles, whose links are no links of the page."""
    return F.regexp_replace(html, UNSEEN, " ")


def _attribute(name: str) -> str:
    return rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""


def _value(tag: Column, name: str) -> Column:
    """An attribute of a tag, in either kind of quotation marks; null where it isn't there or is empty."""
    found = F.concat(F.regexp_extract(tag, _attribute(name), 1), F.regexp_extract(tag, _attribute(name), 2))
    return F.nullif(unescaped(found), F.lit(""))


def all_links(df: DataFrame, html: str = "html") -> DataFrame:
    """One row per link of a page, entities decoded."""
    found = F.regexp_extract_all(elements_only(F.col(html)), F.lit(_attribute("href")), F.lit(0))
    links = F.filter(F.transform(found, lambda a: _value(a, "href")), lambda x: x.isNotNull())
    return df.withColumn("link", F.explode(links)).drop(html)


def titled_links(df: DataFrame, html: str = "html", title: str = JSON_LINK_TITLE, site: str = "") -> DataFrame:
    """Links of the anchors with a given title, whatever the order of their attributes."""
    anchors = F.regexp_extract_all(elements_only(F.col(html)), F.lit(r"(?is)<a\b[^>]*>"), F.lit(0))
    wanted = F.filter(anchors, lambda a: _value(a, "title") == title)
    links = F.transform(wanted, lambda a: F.concat(F.lit(site), _value(a, "href")))
    return df.withColumn("link", F.explode(F.filter(links, lambda x: x.isNotNull()))).drop(html)


# Links below other elements count at any depth.
LINK_ELEMENT = r"(?s)<rdfs:ressource\b[^>]*>(.*?)</rdfs:ressource>"


def read_catalogue(spark: SparkSession, *paths: str, tag: str = "dcat:dataset") -> DataFrame:
    """Entries of catalogue documents, read one by one: date, links of their own, and all else in them as text."""
    reader = spark.read.format("xml").option("rowTag", tag).option("wildcardColName", "rest").option("ignoreSurroundingSpaces", True)
    return reader.schema("`dct:issued` string, `rdfs:ressource` array<string>, rest array<string>").load(list(paths))


def catalogue_urls(entries: DataFrame) -> DataFrame:
    """The JSON link of every entry and its month of publication.

    Without a JSON link the last link counts; without any link the entry is left out.
    """
    nested = F.regexp_extract_all(F.coalesce(F.array_join("rest", ""), F.lit("")), F.lit(LINK_ELEMENT), F.lit(1))
    own = F.coalesce(F.col("`rdfs:ressource`"), F.array().cast("array<string>"))
    links = F.transform(F.concat(own, nested), lambda u: F.trim(u))
    first_json = F.get(F.filter(links, lambda u: F.contains(u, F.lit(JSON_PATH))), F.lit(0))
    last = F.when(F.size(links) > 0, F.element_at(links, -1))
    return entries.select(
        F.coalesce(first_json, last).alias("url"), F.substring(F.trim(F.col("`dct:issued`")), 1, 7).alias("month")
    ).where(F.col("url").isNotNull() & (F.col("url") != ""))


def json_urls_only(urls: DataFrame) -> DataFrame:
    return urls.where(F.contains("url", F.lit(JSON_PATH)))


def interface_records(df: DataFrame) -> DataFrame:
    """Records of the procurement interface in the newer layout.

    Columns in: id, objet, nature, procedure, dureeMois, datePublicationDonnees, modifications and the
    struct ``donneesMP`` with the rest.
    """
    d = "donneesMP."

    def listed(name: str, child: str) -> Column:
        return F.struct(F.array(F.col(d + child)).alias(child)).alias(name)

    same = [
        "idAccordCadre",
        "codeCPV",
        "dateNotification",
        "attributionAvance",
        "tauxAvance",
        "origineUE",
        "origineFrance",
        "ccag",
        "offresRecues",
        "montant",
        "formePrix",
        "typeGroupementOperateurs",
        "sousTraitanceDeclaree",
    ]
    holders = F.coalesce(
        F.transform(F.col(d + "titulaires"), lambda t: F.struct(t.alias("titulaire"))),
        F.array().cast("array<struct<titulaire:struct<typeIdentifiant:string,id:string>>>"),
    )
    return df.select(
        F.concat(F.col(d + "idAcheteur"), F.col("id")).alias("uid"),
        "id",
        "objet",
        "nature",
        "procedure",
        "dureeMois",
        "datePublicationDonnees",
        F.struct(F.col(d + "idAcheteur").alias("id")).alias("acheteur"),
        listed("techniques", "technique"),
        listed("modalitesExecution", "modaliteExecution"),
        listed("typesPrix", "typePrix"),
        F.struct(
            F.col(d + "lieuExecutionCode").alias("code"), F.col(d + "lieuExecutionTypeCode").alias("typeCode")
        ).alias("lieuExecution"),
        *[F.col(d + n).alias(n) for n in same],
        F.col(d + "marchesInnovant").alias("marcheInnovant"),
        holders.alias("titulaires"),
        "modifications",
        F.lit(INTERFACE_SOURCE).alias("source"),
    )
