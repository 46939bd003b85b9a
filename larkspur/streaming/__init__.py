"""Structured Streaming ingestion, rule checks and joins."""
