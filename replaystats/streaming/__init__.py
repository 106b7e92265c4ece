"""Structured Streaming forms of ingest and of the snapshot job."""
