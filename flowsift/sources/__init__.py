"""Scans, sinks and views over the given tables."""
