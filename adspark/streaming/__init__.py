"""Structured Streaming ingestion of arriving report / entity files."""
