"""Structured Streaming jobs: ingest, scoring, profiles and keyed state."""
