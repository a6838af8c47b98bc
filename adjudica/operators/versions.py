"""Versions of a record: amendments folded in, values carried forward, numbers and current flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adjudica.operators.columns import any_filled, starting_with
from adjudica.operators.dedup import keep_first
from adjudica.operators.joins import null_safe_left
from adjudica.operators.ordered import LAST, placed, running
from adjudica.session import materialise


def _ascending(names: Sequence[str]) -> list[Column]:
    return [F.col(n).asc_nulls_first() for n in names]


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """Fill a null with the last value before it within the key.

    Rows are taken in ``order``, ties in order of the carried columns, so equal rows get equal values. Rows are dealt by
    ranges of that order, so one plan serves keys of all sizes, also a key all of whose rows have one date.
    """
    rows = placed(df, _ascending([*keys, *order, *carry]), "to-fill")
    filled = running(rows, list(keys), {f"_fill_{c}": (LAST, F.col(f"`{c}`")) for c in carry})
    return filled.select(*[F.col(f"_fill_{c}").alias(c) if c in carry else F.col(f"`{c}`") for c in df.columns])


def apply_versions(
    df: DataFrame,
    keys: Sequence[str] = ("uid",),
    changing: Sequence[str] = ("dateNotification", "datePublicationDonnees", "montant", "dureeMois", "titulaires"),
    carry: Sequence[str] = ("montant", "dureeMois", "titulaires"),
    prefix: str = "modification_",
    suffix: str = "Modification",
) -> DataFrame:
    """One complete row per version of a record.

    The input has one row per amendment, with the amended values in columns that start with ``prefix``, and
    the base values beside them. ``changing`` names what an amendment may change, its first entry being
    the date; what is in ``carry`` keeps its last value where an amendment leaves it out. All other
    columns come from the base row of the key.

    The base row is chosen with one row per key left in every map task. Where a key has no amendment, that row is the
    result. Else it and the amendments are dealt by ranges of key and date, along which the carried values go forward and
    the columns of the base row both ways.
    """
    source_of = {
        c.removeprefix(prefix).removesuffix(suffix): c for c in starting_with(df, prefix) if c != f"{prefix}id"
    }
    versioned = [*changing, *[c for c in source_of if c not in changing]]
    keys = list(keys)
    plain = [c for c in df.columns if not c.startswith(prefix)]
    fixed = [c for c in plain if c not in versioned and c not in keys]
    order = [changing[0], "_amended", *[c for c in versioned[1:] if c not in carry]]
    carry = list(carry)

    has_amendment = any_filled(source_of.values())
    # A key with a null matches none here and goes with the amended ones, where nulls are equal.
    hits = df.where(has_amendment).select(*keys).distinct().withColumn("_hit", F.lit(True))
    amended = F.col("_hit").isNotNull()
    for k in keys:
        amended = amended | F.col(f"`{k}`").isNull()
    # Written once, since both kinds of records come from it.
    base = keep_first(df.select(*plain), keys).join(hits, keys, "left").withColumn("_is_amended", amended).drop("_hit")
    base = materialise(base, "base", ["_is_amended"])

    # What was written may hold nulls on every level, so its types are those to cast to.
    types = {f.name: f.dataType for f in [*df.schema, *base.schema]}
    kind = {c: types[c] if c in types else types[source_of[c]] for c in versioned}
    original = F.struct(
        *[(F.col(c) if c in plain else F.lit(None)).cast(kind[c]).alias(c) for c in versioned], F.lit(0).alias("_amended")
    )
    amendment = F.struct(
        *[(F.col(source_of[c]) if c in source_of else F.lit(None)).cast(kind[c]).alias(c) for c in versioned],
        F.lit(1).alias("_amended"),
    )
    later = df.where(has_amendment).select(*keys, F.inline(F.array(amendment)))
    # A record without amendments is its own only version.
    alone = base.where("not _is_amended").select(*keys, *[F.col(c).cast(kind[c]).alias(c) if c in plain else F.lit(None).cast(kind[c]).alias(c) for c in versioned], *fixed)
    first = base.where("_is_amended").select(*keys, F.struct(F.lit(0).alias("_"), *fixed).alias("_fixed"), F.inline(F.array(original)))
    rows = placed(first.unionByName(later, allowMissingColumns=True), _ascending([*keys, *order, *carry]), "versions")
    values = {f"_fill_{c}": (LAST, F.col(c)) for c in carry}
    filled = running(rows, keys, {**values, "_before": (LAST, F.col("_fixed"))}, {"_after": (LAST, F.col("_fixed"))})
    own = F.coalesce("_before", "_after")
    versions = filled.select(
        *keys, *[F.col(f"_fill_{c}").alias(c) if c in carry else F.col(c) for c in versioned], *[own[c].alias(c) for c in fixed]
    )
    return versions.unionByName(alone)


def number_versions(
    df: DataFrame,
    key: str = "uid",
    date: str = "dateNotification",
    number: str = "modification_id",
    current: str = "donneesActuelles",
) -> DataFrame:
    """Number the versions of a key by date from 0 and flag the last; a null date has neither.

    Numbers are given to the distinct dates of a key, which are no more than days however many rows it has, and then
    meet the rows. One plan serves keys of all sizes; Spark splits the rows of a hot one in the join.
    """
    by_date = Window.partitionBy(key).orderBy(date)
    last = F.max(date).over(Window.partitionBy(key))
    dates = df.select(key, date).where(F.col(date).isNotNull()).distinct()
    numbered = dates.select(
        key,
        date,
        (F.row_number().over(by_date) - 1).cast("smallint").alias(number),
        (F.col(date) == last).alias(current),
    )
    return null_safe_left(df, numbered, [key, date])


def version_order(df: DataFrame, key: str = "uid", date: str = "dateNotification") -> DataFrame:
    """Keys in order, the newest version first, undated versions before it."""
    return df.orderBy(F.col(key).asc_nulls_first(), F.col(date).desc_nulls_first())
