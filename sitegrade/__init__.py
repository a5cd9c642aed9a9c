"""Inspection-risk analytics as PySpark DataFrame operators."""
