"""Streaming ingestion and incremental upsert."""
