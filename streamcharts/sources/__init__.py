"""Readers: parquet tables mapped onto the domain, message streams, logs, schemas."""
