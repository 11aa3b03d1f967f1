"""Telecom medallion analytics expressed as plain Spark DataFrame operations."""
