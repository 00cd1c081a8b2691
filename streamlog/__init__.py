"""Partitioned message logs on Spark: ranges, splits, conversion, routing, publishing, integrity and metrics."""
