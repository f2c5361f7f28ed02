"""Readers, ingest normalisation and product writers."""
