"""Flight on-time analytics as Spark DataFrame jobs."""
