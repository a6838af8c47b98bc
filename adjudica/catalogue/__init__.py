"""Queries over the given tables, each with the SQL that must give the same rows."""

from adjudica.catalogue.registry import ORACLE, QUERIES
from adjudica.catalogue import (  # noqa: F401  (registers the queries)
    cleaning,
    documents,
    joins,
    places,
    reports,
    tables,
    versions,
)

__all__ = ["ORACLE", "QUERIES"]
