"""gramspan: pattern-based span detection and dataset building on Spark."""

__version__ = "0.1.0"
