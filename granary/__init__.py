"""Layered retail analytics as plain Spark DataFrame plans."""
