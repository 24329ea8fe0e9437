"""Incremental ingestion of newly landed files with Structured Streaming."""
