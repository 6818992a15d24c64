"""Named queries over the supplied tables, with SQL twins where SQL can say them."""

from __future__ import annotations

from importlib import import_module

from opinion_spark.catalog import registry

SECTIONS = ["features", "cleaning", "aggregates", "assess", "serve", "jobs"]


def load():
    """Import every section and return (queries, oracles)."""
    for section in SECTIONS:
        import_module(f"opinion_spark.catalog.{section}")
    return registry.QUERIES, registry.ORACLES
