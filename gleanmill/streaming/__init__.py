"""Incremental runs over a growing input."""
