"""Change capture, history and reconciliation operators on Spark DataFrames."""

__version__ = "0.1.0"
