"""Structured Streaming jobs: position ingest with dedup (ST1-ST3) and live gap alerts (ST4)."""
