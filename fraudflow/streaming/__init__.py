"""fraudflow.streaming."""
