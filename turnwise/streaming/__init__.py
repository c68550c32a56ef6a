"""Structured Streaming jobs: sessions, dedup, redaction, live roll-ups."""
