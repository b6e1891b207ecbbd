"""Incremental ingest of raw files."""
