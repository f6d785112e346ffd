"""Scans and sinks (NDJSON(.gz), JSON documents, Parquet zstd, listings)."""
