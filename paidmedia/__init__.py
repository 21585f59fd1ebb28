"""Paid-media analytics as Spark DataFrame operators."""
