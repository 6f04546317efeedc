"""Structured Streaming entry points (file pickup into Bronze)."""
