"""Structured Streaming jobs: event time, day folders, change feeds, topics."""
