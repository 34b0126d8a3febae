"""Streaming forms of ingest, upsert and row checks."""
