"""Connected components by alternating star contraction; each round is a stored table, so lost executors cost one round."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxstrata.operators import components as shared

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u, v) of longs; root is the least node reachable. No edges: no rows."""
    return shared.components(edges, lambda x: stored(x, "edges"))
