"""Structured Streaming entry points (ST1, ST2)."""
