"""Curation and sequence analytics on Spark."""
