"""Registered queries, each with SQL that must give the same rows."""

from . import image_queries, queries  # noqa: F401  registered by being imported
