"""Typed readers, result sinks and the builders for the given tables."""
