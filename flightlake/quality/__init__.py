"""Profiling and the raw, clean and warehouse quality suites."""
