"""Structured Streaming: incremental ingestion of record batches (the reference fetches in batches)."""
