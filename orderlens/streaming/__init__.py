"""Incremental ingest of a landing folder with Structured Streaming (see landing.py)."""
