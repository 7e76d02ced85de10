"""Structured Streaming jobs: poll rounds to log, log to state."""
