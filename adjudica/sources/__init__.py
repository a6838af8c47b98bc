"""Readers: tables, documents of nested records, catalogues and the list of resources."""
