"""Structured Streaming jobs: ingest, dead letters, windows, alerts."""
