"""Schemas, readers, writers and the views over the shared test tables."""
