"""Structured Streaming jobs: event ingest, quality look-back, windowed statistics."""
