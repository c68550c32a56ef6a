"""DataFrame -> DataFrame operators: scans, turns, sessions, dedup, roll-ups."""
