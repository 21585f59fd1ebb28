"""Schemas, readers, writers and the tables derived from the raw data."""
