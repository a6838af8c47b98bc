"""Nested record documents: JSON in two layouts, JSON lines and XML, flattened to one row per amendment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from adjudica.functions import nested
from adjudica.sources.layouts import BLOCKS, LAYOUTS, LIST_FIELDS, PLAIN_FIELDS, RECORD

PAYLOAD = "payload"
TEXT_LIST = "array<string>"


def read_payloads(spark: SparkSession, *paths: str) -> DataFrame:
    """Whole documents as text with the path they came from, one row per file."""
    texts = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(list(paths), wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias(PAYLOAD))


def layout_of(payload: Column) -> Column:
    """The layout whose record path is present in a document; null where neither is.

    Only the field at the top counts, by the kind of its value: a list of records, or an object with the list, or one
    record, in it.
    """
    body = F.ltrim(F.from_json(payload, "marches string")["marches"])
    inner = F.ltrim(F.from_json(body, "marche string")["marche"])
    wrapped = body.startswith("{") & (inner.startswith("[") | inner.startswith("{"))
    return F.when(body.startswith("["), F.lit("2019")).when(wrapped, F.lit("2022"))


def _listed(payload: Column, layout: str) -> Column:
    """A document of the newer layout with one record in place of a list gets a list of one."""
    if layout != "2022":
        return payload
    one = F.ltrim(F.from_json(payload, "marches struct<marche:string>")["marches"]["marche"])
    return F.when(one.startswith("{"), F.concat(F.lit('{"marches":{"marche":['), one, F.lit("]}}"))).otherwise(payload)


def _nest(path: tuple[str, ...]) -> StructType:
    inner = ArrayType(RECORD)
    for name in reversed(path):
        inner = StructType([StructField(name, inner)])
    return inner


def records(payloads: DataFrame, layout: str) -> DataFrame:
    """Records of all documents of one layout, with the other columns of their document; null records go.

    The layout is taken from a column of that name if there is one, else from the text.
    """
    path, origin = LAYOUTS[layout].path, [c for c in payloads.columns if c not in (PAYLOAD, "layout")]
    found = F.col("layout") if "layout" in payloads.columns else layout_of(F.col(PAYLOAD))
    document = payloads.where(found == layout).select(
        *origin, F.from_json(_listed(F.col(PAYLOAD), layout), _nest(path)).alias("document")
    )
    listed = document.select(*origin, F.explode(F.col("document." + ".".join(path))).alias("record"))
    return listed.where("record is not null").select(*origin, "record.*")


def rejected(payloads: DataFrame) -> DataFrame:
    """Documents in which neither record path is found."""
    return payloads.where(layout_of(F.col(PAYLOAD)).isNull())


REJECTED = "_rejected"


def judged_lines(lines: DataFrame) -> DataFrame:
    """Records of lines of JSON, and in ``_rejected`` a line that is none; the other columns are kept, blank lines go."""
    origin = [c for c in lines.columns if c != "value"]
    kept = lines.where(F.trim(F.regexp_replace("value", "\\s", " ")) != "")
    parsed = kept.select(*origin, "value", F.from_json("value", StructType([*RECORD.fields, StructField("_corrupt_record", StringType())])).alias("r"))
    bad = F.col("r").isNull() | F.col("r._corrupt_record").isNotNull() | ~F.ltrim("value").startswith("{")
    return parsed.select(*origin, F.when(bad, F.col("value")).alias(REJECTED), *[F.when(~bad, F.col(f"r.`{c}`")).alias(c) for c in RECORD.names])


def read_record_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON lines with one record each: splittable, unknown fields dropped, missing ones null; see ``rejected_lines``."""
    return judged_lines(_lines(spark, paths)).where(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines that are no record, with their file."""
    return judged_lines(_lines(spark, paths)).where(F.col(REJECTED).isNotNull()).select("path", F.col(REJECTED).alias("line"))


def _lines(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    return spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")


def flatten(df: DataFrame, layout: str) -> DataFrame:
    """One row per amendment and one for the base, with ``modification_`` columns, all values as text.

    Columns that are not part of a record, such as its path, are kept.
    """
    if layout == "2019":
        lists = [F.from_json(name, TEXT_LIST).alias(name) for name in LIST_FIELDS]
    else:
        lists = [
            F.from_json(F.get_json_object(name, f"$.{child}"), TEXT_LIST).alias(f"{name}_{child}")
            for name, child in LIST_FIELDS.items()
        ]
    changes = nested.amendments(F.col("modifications"))
    base = df.select(
        *[c for c in df.columns if c not in RECORD.names],
        *PLAIN_FIELDS,
        *([F.col("`acheteur.id`")] if layout == "2019" else []),
        F.col("acheteur.id").alias("acheteur_id"),
        F.col("lieuExecution.code").alias("lieuExecution_code"),
        F.col("lieuExecution.typeCode").alias("lieuExecution_typeCode"),
        nested.parse_holders(F.col("titulaires"), layout).alias("titulaires"),
        *lists,
        changes.alias("_changes"),
    )
    # The first row of a record has no amendment.
    rows = base.withColumn("_change", F.explode(F.concat(F.array(F.lit(None)), F.col("_changes")))).drop("_changes")
    amended = {
        f"modification_{f}": F.col(f"_change.{f}") for f in nested.AMENDMENT_FIELDS if f != "titulaires"
    } | {"modification_titulaires": nested.parse_holders(F.col("_change.titulaires"), layout)}
    return rows.withColumns(amended).drop("_change")


# Record elements of the XML form. Lists are read as such, so that one child is a list of one.
_XML_HOLDERS = "struct<titulaire:array<struct<typeIdentifiant:string,id:string>>>"
XML_RECORD = (
    ", ".join(f"{n} string" for n in PLAIN_FIELDS)
    + ", acheteur struct<id:string>, lieuExecution struct<code:string,typeCode:string>, titulaires "
    + _XML_HOLDERS
    + ", "
    + ", ".join(f"{n} struct<{child}:array<string>>" for n, child in LIST_FIELDS.items())
    + ", modifications struct<modification:array<struct<dateNotificationModification:string,"
    + "datePublicationDonneesModification:string,montant:string,dureeMois:string,titulaires:"
    + _XML_HOLDERS
    + ">>>"
)


XML_NAMES = [*PLAIN_FIELDS, "acheteur", "lieuExecution", *LIST_FIELDS, *BLOCKS]


# Where ISO-8859-15 and Windows-1252 differ from ISO-8859-1.
LATIN_9 = ("\u00a4\u00a6\u00a8\u00b4\u00b8\u00bc\u00bd\u00be", "\u20ac\u0160\u0161\u017d\u017e\u0152\u0153\u0178")
WINDOWS = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f",
    "\u20ac\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\u017d\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\u017e\u0178",
)


def decoded(content: Column, encoding: Column) -> Column:
    """Bytes as text by the name of their encoding; one that isn't known is taken as UTF-8."""
    latin = F.decode(content, "ISO-8859-1")

    def differing(table: tuple[str, str]) -> Column:
        # Most texts have none of these characters, and a search is much faster than a look at each of them.
        return F.when(F.rlike(latin, F.lit(f"[{table[0]}]")), F.translate(latin, *table)).otherwise(latin)

    return (
        F.when(encoding == "ISO-8859-1", latin)
        .when(encoding == "ISO-8859-15", differing(LATIN_9))
        .when(encoding == "WINDOWS-1252", differing(WINDOWS))
        .otherwise(content.cast("string"))
    )


def _as_wrapped(holders: Column) -> Column:
    return F.transform(holders["titulaire"], lambda h: F.struct(h.alias("titulaire")))


def flatten_xml(df: DataFrame) -> DataFrame:
    """XML records in the same flat form as JSON records of the newer layout."""
    rows = df.select(
        *[c for c in df.columns if c not in XML_NAMES],
        *PLAIN_FIELDS,
        F.col("acheteur.id").alias("acheteur_id"),
        F.col("lieuExecution.code").alias("lieuExecution_code"),
        F.col("lieuExecution.typeCode").alias("lieuExecution_typeCode"),
        _as_wrapped(F.col("titulaires")).alias("titulaires"),
        *[F.col(f"{n}.{child}").alias(f"{n}_{child}") for n, child in LIST_FIELDS.items()],
        F.explode(
            F.concat(F.array(F.lit(None)), F.coalesce(F.col("modifications.modification"), F.array()))
        ).alias("_change"),
    )
    amended = {
        f"modification_{f}": F.col(f"_change.{f}") for f in nested.AMENDMENT_FIELDS if f != "titulaires"
    } | {"modification_titulaires": _as_wrapped(F.col("_change.titulaires"))}
    return rows.withColumns(amended).drop("_change")


def with_source(df: DataFrame, dataset: str | Column, resource: str | Column, prefix_by_sender: bool = False) -> DataFrame:
    """Where a row comes from; a merged data set is told apart by the sender its rows name."""
    code = F.lit(dataset) if isinstance(dataset, str) else dataset
    origin = F.concat(code, F.lit("_"), F.col("source")) if prefix_by_sender else code
    link = F.lit(resource) if isinstance(resource, str) else resource
    return df.withColumns({"sourceFile": link, "sourceDataset": origin}).drop("source")
