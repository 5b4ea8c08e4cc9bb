"""Cleaning of both source layouts, deduplication, ordering and keys."""
