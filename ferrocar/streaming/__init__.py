"""Incremental page ingest."""
