"""Voxel aggregation: centres of mass and representatives, exact and independent of row order.

One shuffle per call: sums, and where a representative is asked, a window over the same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxstrata.functions.lattice import exact_div, floor_div, half_even

KEY = ("kx", "ky", "kz")


def with_voxels(points: DataFrame, resolution: int | Column) -> DataFrame:
    return points.withColumns({k: floor_div(a, resolution) for k, a in zip(KEY, ("X", "Y", "Z"), strict=True)})


def centers(points: DataFrame, resolution: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean of each voxel's points, rounded once to the lattice (halves to even)."""
    sums = with_voxels(points, resolution).groupBy(*keys, *KEY).agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in "XYZ"))
    return sums.select(*keys, *KEY, "n", *(half_even(f"s{a}", "n").alias(a) for a in "XYZ"))


def centers_multi(points: DataFrame, resolutions: list[int], keys: tuple[str, ...] = ()) -> DataFrame:
    """Several resolutions from one scan; each is computed from the points themselves. Resolution 0 passes points through."""
    coarse = [r for r in resolutions if r > 0]
    spread = points.select(*keys, "X", "Y", "Z", F.explode(F.array(*(F.lit(r).cast("long") for r in coarse))).alias("res"))
    sums = with_voxels(spread, F.col("res")).groupBy(*keys, "res", *KEY).agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in "XYZ"))
    out = sums.select(*keys, "res", *KEY, "n", *(half_even(f"s{a}", "n").alias(a) for a in "XYZ"))
    if 0 in resolutions:
        null = F.lit(None).cast("long")
        out = out.unionByName(points.select(*keys, F.lit(0).cast("long").alias("res"), *(null.alias(k) for k in KEY), F.lit(1).cast("long").alias("n"), "X", "Y", "Z"))
    return out


def _off_mean(keys: tuple[str, ...]) -> Column:
    """Sum over axes of ``(n * v - sum)^2``: orders a voxel's points by distance from its mean, in whole numbers."""
    w = Window.partitionBy(*keys, *KEY)
    wide = lambda c: c.cast("decimal(18,0)")
    terms = [wide(F.count("*").over(w) * F.col(a) - F.sum(a).over(w)) for a in "XYZ"]
    return sum((t * t for t in terms[1:]), terms[0] * terms[0]).cast("decimal(38,0)")


def representatives(points: DataFrame, resolution: int, keys: tuple[str, ...] = (), ties: tuple[str, ...] = ("X", "Y", "Z")) -> DataFrame:
    """The real point nearest to each voxel's mean; ties by the least ``ties``. All columns stay, with ``n`` points."""
    near = with_voxels(points, resolution).withColumn("_off", _off_mean(keys)).withColumn("n", F.count("*").over(Window.partitionBy(*keys, *KEY)))
    first = Window.partitionBy(*keys, *KEY).orderBy("_off", *ties)
    return near.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").select(*points.columns, *KEY, "n")


def product_picks(points: DataFrame, resolution: int, gps: str) -> DataFrame:
    """One representative per voxel over all inputs, ties by all columns in order; rows are sorted by (gps time, all columns).
    """
    picked = representatives(points, resolution, ties=("X", "Y", "Z", *(c for c in points.columns if c not in "XYZ")))
    return picked.orderBy(gps, *points.columns)


def tile_product(points: DataFrame, tiles: DataFrame, length: int, buffer: int, resolutions: list[int]) -> DataFrame:
    """The tiling product: occupied tiles' buffered points, reduced to every resolution.

    One scan and one shuffle of partial sums: each voxel remembers if any of its points lies in its tile's core, and tiles
    without such a voxel are left out afterwards, from the same shuffle.
    """
    from voxstrata.operators import grid

    if not isinstance(tiles, grid.Frame):
        kept = grid.core_occupancy(points, tiles, length).filter("kept").select("tile")
        routed = grid.assign_buffered(points.select("X", "Y", "Z"), tiles, length, buffer)
        return centers_multi(routed, resolutions, ("tile",)).join(kept, "tile", "left_semi")
    col = exact_div(F.col("tile") - F.pmod("tile", F.lit(tiles.rows)), F.lit(tiles.rows))
    x0, y0 = col * length + tiles.x, F.pmod("tile", F.lit(tiles.rows)) * length + tiles.y
    core = (F.col("X") >= x0) & (F.col("X") <= x0 + length) & (F.col("Y") >= y0) & (F.col("Y") <= y0 + length)
    routed = tiles.assign(points.select("X", "Y", "Z"), buffer).withColumn("core", core)
    spread = routed.withColumn("res", F.explode(F.array(*(F.lit(r).cast("long") for r in resolutions if r > 0))))
    sums = with_voxels(spread, F.col("res")).groupBy("tile", "res", *KEY).agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a}") for a in "XYZ"), F.max("core").alias("core"))
    kept = (sums if any(resolutions) else routed).filter("core").select("tile").distinct()
    out = sums.select("tile", "res", *KEY, "n", *(half_even(f"s{a}", "n").alias(a) for a in "XYZ"))
    if 0 in resolutions:
        null = F.lit(None).cast("long")
        out = out.unionByName(routed.select("tile", F.lit(0).cast("long").alias("res"), *(null.alias(k) for k in KEY), F.lit(1).cast("long").alias("n"), "X", "Y", "Z"))
    return out.join(kept, "tile", "left_semi")
