"""Data-quality validation, repair, drift and model gating as Spark DataFrame operators."""

__version__ = "0.1.0"
