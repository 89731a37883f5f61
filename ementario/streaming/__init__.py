"""Structured Streaming jobs: incremental file loads and keyed upserts."""
