"""Which tile keeps a point where tiles overlap: core filter, shared points, background, conflicts, duplicates.

All take rows (tile, pid, X, Y, Z, inst, sem). A pair of tiles' points meets through the cell join of ``nearest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxstrata.functions.lattice import rect_distance2
from voxstrata.operators import grid, instances, nearest
from voxstrata.operators.lineage import cut

KEYS = ("tile", "pid")


def core_filter(points: DataFrame, tiles: DataFrame, linked: DataFrame, anchor: str = "centroid") -> DataFrame:
    """Whole instances whose anchor a tile owns, and the background points it owns."""
    owned = grid.owned_anchors(instances.anchors(points, anchor, ("tile", "inst")), tiles, linked).select("tile", "inst")
    trees = points.filter("inst > 0").join(owned, ["tile", "inst"], "left_semi")
    return trees.unionByName(grid.owned_background(points.filter("inst = 0"), tiles, linked))


def _core(tiles: DataFrame, prefix: str) -> DataFrame:
    return tiles.select(F.col("tile").alias(f"{prefix}_tile"), *(F.col(c).alias(f"{prefix}_{c}") for c in ("x0", "x1", "y0", "y1")))


def _distance(point: str, core: str) -> Column:
    c = lambda n: F.col(f"{core}_{n}")
    return rect_distance2(F.col(f"{point}_X"), F.col(f"{point}_Y"), c("x0"), c("x1"), c("y0"), c("y1"))


def _preferred(point: str, one: str, other: str) -> Column:
    """Whether ``one``'s core goes before ``other``'s for a point: nearer, then earlier."""
    return F.struct(_distance(point, one), F.col(f"{one}_tile")) < F.struct(_distance(point, other), F.col(f"{other}_tile"))


def shared_losers(points: DataFrame, tiles: DataFrame, limit2: int) -> DataFrame:
    """Keys of tree points that a competitor of another tile within reach owns: its core goes before at both points."""
    trees = points.filter("inst > 0").select("tile", "pid", "X", "Y", "Z")
    found = nearest.pairs(trees, trees, limit2, where=F.col("q_tile") != F.col("b_tile"))
    found = found.join(_core(tiles, "q"), "q_tile").join(_core(tiles, "b"), "b_tile")
    lost = found.filter(_preferred("q", "b", "q") & _preferred("b", "b", "q"))
    return lost.select(F.col("q_tile").alias("tile"), F.col("q_pid").alias("pid")).distinct()


def shared_points(points: DataFrame, tiles: DataFrame, limit2: int) -> DataFrame:
    return points.join(shared_losers(points, tiles, limit2), list(KEYS), "left_anti")


def tree_over_background(points: DataFrame, limit2: int) -> DataFrame:
    """Background points within reach of another tile's tree point go."""
    ground, trees = points.filter("inst = 0"), points.filter("inst > 0").select("tile", "pid", "X", "Y", "Z")
    kept = nearest.not_exists_within(ground.select("tile", "pid", "X", "Y", "Z"), trees, limit2, KEYS, where=F.col("q_tile") != F.col("b_tile"))
    return points.filter("inst > 0").unionByName(ground.join(kept.select(*KEYS), list(KEYS), "left_semi"))


def conflicts(points: DataFrame, tiles: DataFrame, limit2: int, background_sem: int = 0) -> DataFrame:
    """Pairs of different tiles' points within reach whose labels differ, each later point against all earlier ones.

    Exempt: both of background semantics, and pairs whose preferred cores are different tiles.
    """
    rows = points.select("tile", "pid", "X", "Y", "Z", "inst", "sem")
    found = nearest.pairs(rows, rows, limit2, where=(F.col("b_tile") < F.col("q_tile")) & ((F.col("b_inst") != F.col("q_inst")) | (F.col("b_sem") != F.col("q_sem"))))
    found = found.join(_core(tiles, "q"), "q_tile").join(_core(tiles, "b"), "b_tile")
    ground = (F.col("q_inst") == 0) & (F.col("b_inst") == 0) & (F.col("q_sem") == background_sem) & (F.col("b_sem") == background_sem)
    apart = _preferred("q", "q", "b") & _preferred("b", "b", "q")
    return found.filter(~ground & ~apart).select(F.col("q_tile").alias("tile"), F.col("q_pid").alias("pid"), F.col("b_tile").alias("other"), F.col("b_pid").alias("other_pid"), "d2")


def _duplicates(later: DataFrame, earlier: DataFrame, limit2: int) -> DataFrame:
    best = nearest.nearest(later, earlier, limit2, KEYS, where=F.col("b_tile") < F.col("q_tile"))
    same = best.join(later.select(*KEYS, "inst", "sem"), list(KEYS)).filter((F.col("inst") == F.col("b_inst")) & (F.col("sem") == F.col("b_sem")))
    return same.select(*KEYS)


def waves(overlapping: list[tuple[int, int]]) -> dict[int, int]:
    """Level of each tile: one more than the largest of earlier tiles that it overlaps; others are independent."""
    level: dict[int, int] = {}
    for later, earlier in sorted(overlapping):
        level[later] = max(level.get(later, 0), level.get(earlier, 0) + 1)
    return level


def deduplicate(points: DataFrame, overlapping: DataFrame, limit2: int) -> DataFrame:
    """Drop a point whose nearest surviving point of an earlier tile within reach has the same labels.

    Tiles compare with survivors, so levels of tiles run one after the other: as many joins as the longest chain of
    overlaps (a handful on a grid), each cut off by a checkpoint in the shared folder.
    """
    spark = points.sparkSession
    level = waves([(r[0], r[1]) for r in overlapping.select("later", "earlier").collect()])  # tiles, not points
    if not level:
        return points
    levels = spark.createDataFrame(sorted(level.items()), "tile long, level int")
    rows = cut(points.join(levels, "tile", "left").fillna(0, ["level"]))
    done = rows.filter("level = 0").drop("level")
    for k in range(1, max(level.values()) + 1):
        now = rows.filter(F.col("level") == k).drop("level")
        done = cut(done.unionByName(now.join(_duplicates(now, done, limit2), list(KEYS), "left_anti")))
    return done


def pipeline(points: DataFrame, tiles: DataFrame, limit2: int, *, refuse: bool = False, background_sem: int = 0) -> DataFrame:
    """Shared points, trees over background, a check for conflicts, then duplicates: the order decides the result.

    With ``refuse`` any conflict between what two tiles still say of one place is an error that names the first.
    """
    kept = tree_over_background(shared_points(points, tiles, limit2), limit2)
    if refuse:
        kept = cut(kept)
        first = conflicts(kept, tiles, limit2, background_sem).orderBy("tile", "pid", "other", "other_pid").limit(1).collect()
        if first:
            raise ValueError(f"labels of tiles {first[0].other} and {first[0].tile} conflict at point {first[0].pid}")
    return deduplicate(kept, grid.overlaps(tiles), limit2)
