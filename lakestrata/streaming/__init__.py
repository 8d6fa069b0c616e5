"""Structured Streaming forms of ingest and type discovery."""
