"""Spark jobs that consolidate public-procurement records from many sources."""
