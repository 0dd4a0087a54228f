"""Readers: NDJSON, documents, Parquet tables, streams."""
