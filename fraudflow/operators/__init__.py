"""fraudflow.operators."""
