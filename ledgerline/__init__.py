"""Retail-banking lakehouse jobs written as Spark DataFrame and SQL plans."""
