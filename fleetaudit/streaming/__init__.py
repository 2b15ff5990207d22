"""Continuous reports over a growing directory of snapshot files."""
