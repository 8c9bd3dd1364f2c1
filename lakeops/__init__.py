"""Reusable PySpark operators, streams and jobs for a payments-style lakehouse."""
