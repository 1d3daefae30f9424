"""Imaging-cohort preparation, evaluation and traceability as Spark DataFrame jobs."""

__version__ = "0.1.0"
