"""Incremental ingestion of period files with Structured Streaming."""
