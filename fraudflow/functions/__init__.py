"""fraudflow.functions."""
