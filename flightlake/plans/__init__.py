"""Reporting plans over the star schema and over the clean table."""
