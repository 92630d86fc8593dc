"""Incremental (Structured Streaming) ingestion."""
