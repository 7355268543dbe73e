"""fraudflow.plans."""
