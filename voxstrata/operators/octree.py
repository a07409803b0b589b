"""Level-of-detail octrees: voxel sampling of points, and importance levels of cylinders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxstrata.functions.lattice import exact_div, floor_div
from voxstrata.operators.lineage import cut

NODE = ("nx", "ny", "nz")


def lod_levels(points: DataFrame, origin: tuple[int, int, int], size: int, *, grid: int = 80, leaf: int = 20_000, depth: int = 16, priority: str = "pid") -> DataFrame:
    """Each point's level and node: from the root down, a node with at most ``leaf`` points keeps them all, a fuller one
    keeps the point of least priority in each of its ``grid`` ** 3 voxels and passes the others on.

    Points beyond the cube belong to the nodes at its border, in voxels counted on from there (toward zero below it).
    ``size * 2 ** -depth`` should be a lattice unit or more. Every level is one pass over what remains, cut off by a
    checkpoint; a few levels hold nearly all points.
    """
    rest = points.select("*", *((F.col(a) - o).alias(f"_{a}") for a, o in zip("XYZ", origin, strict=True)))
    done = None
    for level in range(depth + 1):
        cells = 1 << level
        rest = rest.withColumns({n: F.least(F.greatest(floor_div(F.col(f"_{a}") * cells, size), F.lit(0).cast("long")), F.lit(cells - 1).cast("long")) for n, a in zip(NODE, "XYZ", strict=True)})
        if level < depth:
            node = Window.partitionBy(*NODE)
            voxel = Window.partitionBy(*NODE, *(exact_div(F.col(f"_{a}") * (cells * grid), F.lit(size)) for a in "XYZ")).orderBy(priority)
            rest = rest.withColumn("_full", F.count("*").over(node) > leaf).withColumn("_take", ~F.col("_full") | (F.row_number().over(voxel) == 1))
        else:
            rest = rest.withColumn("_take", F.lit(True))
        rest = cut(rest)
        taken = rest.filter("_take").select(*points.columns, F.lit(level).alias("level"), *NODE)
        done = taken if done is None else done.unionByName(taken)
        rest = rest.filter("NOT _take").drop("_take", "_full")
        if rest.isEmpty():
            break
    return done


def level_counts(levels: DataFrame) -> DataFrame:
    return levels.groupBy("level").agg(F.count("*").alias("n"))


def importance_levels(cylinders: DataFrame, size: int, capacity: int, depth: int = 12) -> DataFrame:
    """Each cylinder's node: a node keeps its ``capacity`` most important ones (radius times length, then id), the others
    go to the eight children by their midpoints (mx, my, mz in [0, size))."""
    rest, done = cylinders.withColumn("node", F.lit("r")), None
    for level in range(depth + 1):
        rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("importance"), "id"))
        here = rest.withColumn("_rank", rank)
        here = cut(here)
        taken = here.filter((F.col("_rank") <= capacity) if level < depth else F.lit(True)).drop("_rank").withColumn("level", F.lit(level))
        done = taken if done is None else done.unionByName(taken)
        if level == depth:
            break
        rest = here.filter(F.col("_rank") > capacity).drop("_rank")
        if rest.isEmpty():
            break
        bit = lambda a: F.pmod(floor_div(F.col(a) * (1 << (level + 1)), size), F.lit(2))  # noqa: B023, E731
        rest = rest.withColumn("node", F.concat("node", (bit("mx") * 4 + bit("my") * 2 + bit("mz")).cast("string")))
    return done


def node_statistics(levels: DataFrame) -> DataFrame:
    """Per node: level, count, least and largest radius, and the mask of its children."""
    own = levels.groupBy("node", "level").agg(F.count("*").alias("n"), F.min("radius").alias("min_radius"), F.max("radius").alias("max_radius"))
    parent = F.expr("left(node, length(node) - 1)")
    children = own.filter("level > 0").groupBy(parent.alias("node")).agg(F.expr("bit_or(shiftleft(1, CAST(right(node, 1) AS INT)))").alias("children"))
    return own.join(children, "node", "left").select("node", "level", "n", "min_radius", "max_radius", F.coalesce("children", F.lit(0)).alias("children"))


def tree_volume(trees: DataFrame) -> DataFrame:
    """Per tree: cylinders and volume over its segments (x, y, z, radius, parent_id); a segment without parent is a start."""
    at = lambda i: F.get("segments", i)
    length = lambda s: F.sqrt(sum(((s[a] - at(s["parent_id"])[a]) * (s[a] - at(s["parent_id"])[a]) for a in "xyz"), F.lit(0.0)))
    volumes = F.transform(F.filter("segments", lambda s: s["parent_id"] >= 0), lambda s: F.lit(3.141592653589793) * s["radius"] * s["radius"] * length(s))
    return trees.select("id", F.size(volumes).alias("cylinders"), F.aggregate(volumes, F.lit(0.0), lambda a, v: a + v).alias("volume"))
