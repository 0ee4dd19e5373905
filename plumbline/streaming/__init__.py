"""Incremental validation of arriving dataset versions."""
