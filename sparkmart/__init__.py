"""sparkmart: medallion-style change capture, current state, marts and views on Spark."""

__version__ = "0.1.0"
