"""Incremental intake of landing folders."""
