"""Outcome-risk analytics as PySpark DataFrame operators."""
