"""Operators of a training-data pipeline: sharding, packing, dedup, language ID, scans, decontamination."""
