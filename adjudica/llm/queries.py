"""Queries of this package, each over its whole tables, and the SQL of those that SQL can express."""

from adjudica.llm.common import ORACLE, QUERIES
from adjudica.llm import bpe, collocations, disclosure, kdtree, language, minhash, packing, prefix_trie, secrets, sharding, substrings, token_counts, winnowing  # noqa: F401  (registers the queries)

__all__ = ["ORACLE", "QUERIES"]
