"""Incremental results from streams of changes."""
