"""Column builders: coercing casts, HHMM times, calendar parts, metric grammar."""
