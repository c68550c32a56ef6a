"""Readers, parsers and writers for records, logs, transcripts and usage files."""
