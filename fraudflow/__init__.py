"""fraudflow: transaction-fraud analytics on Spark DataFrames.

Batch and streaming share the same ``DataFrame -> DataFrame`` functions;
only ``fraudflow.sources`` and ``fraudflow.streaming`` know the difference.
"""

__version__ = "0.1.0"
