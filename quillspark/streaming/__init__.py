"""Structured Streaming forms of ingestion, rate counting, scoring and monitoring."""
