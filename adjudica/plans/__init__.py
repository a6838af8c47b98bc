"""Composite jobs, from raw records to published tables."""
