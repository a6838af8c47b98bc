"""The published table as five related tables, with their primary keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from adjudica.operators.columns import starting_with, strip_prefix
from adjudica.operators.dedup import assert_primary_key, keep_first
from adjudica.session import materialise
from adjudica.sinks.files import write_parquet


@dataclass(frozen=True)
class Table:
    df: DataFrame
    key: tuple[str, ...]


def related_tables(df: DataFrame, buyer: str = "acheteur", holder: str = "titulaire") -> dict[str, Table]:
    """Five tables with their keys.

    The distance between buyer and holder belongs to neither alone, so it stays with the holders of a contract.
    """
    distance = [c for c in df.columns if c == f"{holder}_distance"]
    contracts = df.drop(*starting_with(df, buyer, holder))
    companies = [c for c in starting_with(df, holder) if c not in distance]
    return {
        "marches": Table(keep_first(contracts, ["uid", "modification_id"]), ("uid", "modification_id")),
        "acheteurs": Table(
            strip_prefix(df.select(*starting_with(df, buyer)), f"{buyer}_").distinct(), ("id",)
        ),
        "entreprises": Table(
            strip_prefix(df.select(*companies), f"{holder}_").distinct(), ("id", "typeIdentifiant")
        ),
        "marches_titulaires": Table(
            df.select("uid", "modification_id", f"{holder}_id", f"{holder}_typeIdentifiant", *distance),
            ("uid", "modification_id", f"{holder}_id", f"{holder}_typeIdentifiant"),
        ),
        "marches_acheteurs": Table(
            df.select("uid", "modification_id", f"{buyer}_id").distinct(), ("uid", "modification_id", f"{buyer}_id")
        ),
    }


def write_related_tables(df: DataFrame, folder: str) -> None:
    """Write all five tables, once the keys of all are found to be unique.

    The tables are put together once, in the shared folder; a table whose key is repeated stops the run before
    anything is in ``folder``.
    """
    ready = {name: Table(materialise(t.df, name), t.key) for name, t in related_tables(df).items()}
    for table in ready.values():
        assert_primary_key(table.df, table.key)
    for name, table in ready.items():
        write_parquet(table.df, f"{folder}/{name}.parquet")
