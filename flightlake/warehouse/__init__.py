"""Star schema: dimensions, fact, loading, reconciliation."""
