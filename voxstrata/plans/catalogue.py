"""All registered queries over the driver's tables, with their SQL oracles (brute force where it is short)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query; without ``oracle`` its rows are held against tests alone."""

    def keep(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return keep


from voxstrata.plans import queries_entities, queries_forms, queries_points  # noqa: E402, F401
