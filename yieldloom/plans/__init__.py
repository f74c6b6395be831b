"""Composed pipelines: the gold build, and the registered queries on the driver's tables."""
