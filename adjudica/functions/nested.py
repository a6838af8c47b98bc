"""Holder lists, list columns and amendment blocks as they come in the documents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HOLDER = "struct<typeIdentifiant:string,id:string>"
HOLDERS = {"2019": f"array<{HOLDER}>", "2022": f"array<struct<titulaire:{HOLDER}>>"}
OUTER_BRACKETS = r"^\s*(?:\[\s*)*(?=\[)"
AMENDMENT_FIELDS = (
    "dateNotificationModification",
    "datePublicationDonneesModification",
    "montant",
    "dureeMois",
    "titulaires",
)


def innermost_list(text: Column) -> Column:
    """The first innermost of nested lists, as JSON text: all opening brackets but the last go.

    The brackets that are left over at the end do no harm, since ``from_json`` stops after one value.
    """
    return F.regexp_replace(text, OUTER_BRACKETS, "")


def parse_holders(text: Column, layout: str) -> Column:
    """Holder list of one layout from its JSON text; the older layout may nest it."""
    return F.from_json(innermost_list(text) if layout == "2019" else text, HOLDERS[layout])


def non_empty(items: Column) -> Column:
    """An array, or null where it is empty; the array is worked out once."""
    return F.get(F.filter(F.array(items), lambda a: F.size(a) > 0), F.lit(0))


def tidy_holders(holders: Column, layout: str) -> Column:
    """Holders as ``titulaire_id`` and ``titulaire_typeIdentifiant``; void ones and void lists go."""
    inner = (lambda h: h["titulaire"]) if layout == "2022" else (lambda h: h)
    renamed = F.transform(
        holders,
        lambda h: F.struct(
            inner(h)["id"].alias("titulaire_id"), inner(h)["typeIdentifiant"].alias("titulaire_typeIdentifiant")
        ),
    )
    kept = F.filter(
        renamed, lambda h: h["titulaire_id"].isNotNull() | h["titulaire_typeIdentifiant"].isNotNull()
    )
    return non_empty(kept)


def list_text(c: Column) -> Column:
    return F.array_join(c, ", ")


def first_filled_list(main: Column, alternate: Column) -> Column:
    """The alternate list where the main one is there but empty."""
    return F.when(F.size(main) == 0, alternate).otherwise(main)


def _amendment(e: Column) -> Column:
    return F.struct(*[e[f].alias(f) for f in AMENDMENT_FIELDS])


def amendments(text: Column) -> Column:
    """Amendments of a record as an array, whatever their shape.

    A list, one object, an object or list members under ``modification``; texts and nulls give none.
    ``from_json`` reads a bare object as a list of one, which covers the object shapes.
    """
    flat = "array<struct<" + ",".join(f"{f}:string" for f in AMENDMENT_FIELDS) + ">>"
    wrapped = "array<struct<modification:string," + ",".join(f"{f}:string" for f in AMENDMENT_FIELDS) + ">>"
    members = F.filter(F.from_json(text, wrapped), lambda e: e.isNotNull())
    opened = F.transform(
        members,
        lambda e: F.when(e["modification"].isNotNull(), F.from_json(e["modification"], flat)).otherwise(
            F.array(_amendment(e))
        ),
    )
    known = F.filter(opened, lambda a: a.isNotNull())
    return F.coalesce(F.flatten(known), F.from_json(F.lit("[]"), flat))
