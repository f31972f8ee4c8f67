"""Incremental ingestion of raw extracts with Structured Streaming."""
