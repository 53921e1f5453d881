"""Whole jobs: the warehouse load, the benchmark queries and the semantic layer."""
