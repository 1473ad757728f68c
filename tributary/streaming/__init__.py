"""Structured Streaming jobs and transformWithState processors."""
