"""Structured Streaming entry into the warehouse."""
