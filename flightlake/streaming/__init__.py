"""Incremental monthly loading as a file stream."""
