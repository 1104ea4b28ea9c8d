"""Structured Streaming jobs: load each staged file once, upsert what was loaded."""
