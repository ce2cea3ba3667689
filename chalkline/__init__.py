"""Aligning, distilling, indexing and searching timestamped material with Spark."""
