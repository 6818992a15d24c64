"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, build: Query, oracle: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = build
    if oracle is not None:
        ORACLES[name] = oracle


def query(name: str, oracle: str | None = None):
    """Decorator form of :func:`add`."""
    def wrap(build: Query) -> Query:
        add(name, build, oracle)
        return build
    return wrap
