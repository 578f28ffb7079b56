"""Structured Streaming: change-log ingest, state, enrichment and mart refresh."""
