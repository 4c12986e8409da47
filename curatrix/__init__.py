"""Spark jobs and DataFrame operators for curating business-intelligence tables."""
