"""File sources and sinks, and the driver tables seen as flight records."""
