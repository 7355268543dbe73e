"""fraudflow.sources."""
