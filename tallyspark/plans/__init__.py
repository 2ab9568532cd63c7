"""Pipelines: the sales star over the driver tables, the layers, and the
registry of named queries."""
