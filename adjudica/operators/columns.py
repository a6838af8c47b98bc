"""Choosing, naming and ordering columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType


def starting_with(df: DataFrame, *starts: str) -> list[str]:
    return [c for c in df.columns if c.startswith(starts)]


def ending_with(df: DataFrame, *ends: str) -> list[str]:
    return [c for c in df.columns if c.endswith(ends)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, StringType)]


def text_list_columns(df: DataFrame) -> list[str]:
    """Lists of texts, whether or not their type allows null elements."""
    return [f.name for f in df.schema if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StringType)]


def on_columns(df: DataFrame, names: Iterable[str], change) -> DataFrame:
    """Apply one column function to several columns in place."""
    return df.withColumns({n: change(F.col(f"`{n}`")) for n in names})


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in starting_with(df, prefix)})


def add_prefix(df: DataFrame, names: Iterable[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def in_contract_order(df: DataFrame, contract: list[str]) -> DataFrame:
    """Contract columns first and in order, unexpected ones after them."""
    return df.select(*contract, *[c for c in df.columns if c not in contract])


def published_order(df: DataFrame, newest: str = "dateNotification", key: str = "uid") -> DataFrame:
    """Newest first, then by key, nulls last: a range-partitioned sort."""
    return df.orderBy(F.col(newest).desc_nulls_last(), F.col(key).asc_nulls_last())


def any_filled(names: Iterable[str]) -> Column:
    """True where not all of the columns are null."""
    return F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(True)) for n in names], F.lit(False))


def require_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keep rows whose keys are filled; an empty text counts as null."""
    blanked = df.withColumns({k: F.nullif(F.col(k), F.lit("")) for k in keys})
    return blanked.dropna(subset=list(keys))
