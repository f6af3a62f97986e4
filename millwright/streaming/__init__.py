"""Structured Streaming: ingestion and live aggregates."""
