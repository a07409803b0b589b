"""Triangle meshes as two tables: vertices (mesh, vid, x, y, z) and faces (mesh, fid, v0, v1, v2)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def grid_mesh(spark: SparkSession, cols: int, rows: int, step: int, mesh: int = 0, z: str = "100 + x DIV 10") -> tuple[DataFrame, DataFrame]:
    """A regular terrain: two triangles a square, from arithmetic alone."""
    ids = spark.range((cols + 1) * (rows + 1))
    vertices = ids.selectExpr(f"CAST({mesh} AS BIGINT) AS mesh", "id AS vid", f"(id % {cols + 1}) * {step} AS x", f"(id DIV {cols + 1}) * {step} AS y").withColumn("z", F.expr(z).cast("long"))
    corner = f"((id DIV 2) DIV {cols}) * {cols + 1} + (id DIV 2) % {cols}"
    faces = spark.range(2 * cols * rows).selectExpr(
        f"CAST({mesh} AS BIGINT) AS mesh", "id AS fid", f"{corner} AS v0",
        f"IF(id % 2 = 0, {corner} + 1, {corner} + {cols + 2}) AS v1", f"IF(id % 2 = 0, {corner} + {cols + 2}, {corner} + {cols + 1}) AS v2",
    )
    return vertices, faces


def triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces with their corners' coordinates: one join over the three corners, put together by face."""
    corners = faces.select("mesh", "fid", F.posexplode(F.array("v0", "v1", "v2")).alias("k", "vid"))
    joined = corners.join(vertices, ["mesh", "vid"]).groupBy("mesh", "fid")
    return joined.agg(*(F.max(F.when(F.col("k") == k, F.col(a))).alias(f"{a}{k}") for k in range(3) for a in "xyz"))


def area2(prefix: str = "") -> Column:
    """Twice the signed XY area of a triangle."""
    c = lambda n: F.col(prefix + n)
    return (c("x1") - c("x0")) * (c("y2") - c("y0")) - (c("x2") - c("x0")) * (c("y1") - c("y0"))


def extent_class(tri: DataFrame, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    """inside, crossing or outside a closed rectangle, by the triangle's box."""
    lo, hi = {a: F.least(f"{a}0", f"{a}1", f"{a}2") for a in "xy"}, {a: F.greatest(f"{a}0", f"{a}1", f"{a}2") for a in "xy"}
    inside = (lo["x"] >= x0) & (hi["x"] <= x1) & (lo["y"] >= y0) & (hi["y"] <= y1)
    outside = (hi["x"] < x0) | (lo["x"] > x1) | (hi["y"] < y0) | (lo["y"] > y1)
    return tri.withColumn("place", F.when(inside, "inside").when(outside, "outside").otherwise("crossing"))


def core_faces(tri: DataFrame, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    """Faces whose centroid lies in a half-open core (three times the centroid, in whole numbers)."""
    cx, cy = F.col("x0") + F.col("x1") + F.col("x2"), F.col("y0") + F.col("y1") + F.col("y2")
    return tri.filter((cx >= 3 * x0) & (cx < 3 * x1) & (cy >= 3 * y0) & (cy < 3 * y1))


def near_lines(points: DataFrame, lines: DataFrame, band: int) -> DataFrame:
    """Points within ``band`` of any axis-parallel core line (axis, at, lo, hi); lines are as few as tiles: broadcast."""
    across = F.when(F.col("axis") == "x", F.col("x")).otherwise(F.col("y"))
    along = F.when(F.col("axis") == "x", F.col("y")).otherwise(F.col("x"))
    close = (F.abs(across - F.col("at")) <= band) & (along >= F.col("lo") - band) & (along <= F.col("hi") + band)
    return points.join(F.broadcast(lines), close, "left_semi")


def weld(vertices: DataFrame, faces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Equal corners become one (the first in (mesh, vid) order); faces follow. New ids run from 0 in that order."""
    kept = vertices.groupBy("x", "y", "z").agg(F.min(F.struct("mesh", "vid")).alias("first"))
    numbered = numbered_rows(kept.select("x", "y", "z", "first.mesh", "first.vid"), ["mesh", "vid"], "new")
    remap = vertices.join(numbered.select("x", "y", "z", "new"), ["x", "y", "z"]).select("mesh", "vid", "new")
    return numbered.select(F.col("new").alias("vid"), "x", "y", "z"), remapped_faces(faces, remap)


def remapped_faces(faces: DataFrame, remap: DataFrame) -> DataFrame:
    corners = faces.select("mesh", "fid", F.posexplode(F.array("v0", "v1", "v2")).alias("k", "vid")).join(remap, ["mesh", "vid"])
    return corners.groupBy("mesh", "fid").agg(*(F.max(F.when(F.col("k") == k, F.col("new"))).alias(f"v{k}") for k in range(3)))


def numbered_rows(rows: DataFrame, order: list[str], to: str, by: str = "mesh") -> DataFrame:
    """Numbers from 0 in the order of ``by`` and the rest: a window per mesh plus the meshes' offsets (one row a mesh)."""
    inside = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    offsets = counts.select(by, F.coalesce(F.sum("_n").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    return rows.withColumn("_i", inside).join(offsets, by).withColumn(to, F.col("_o") + F.col("_i")).drop("_i", "_o")


def used_vertices(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Vertices that faces use, with new ids from 0 per mesh in the old order."""
    used = faces.select("mesh", F.explode(F.array("v0", "v1", "v2")).alias("vid")).distinct()
    return vertices.join(used, ["mesh", "vid"], "left_semi").withColumn("new", (F.row_number().over(Window.partitionBy("mesh").orderBy("vid")) - 1).cast("long"))


def boundary_edges(faces: DataFrame) -> DataFrame:
    """Edges that belong to one face only."""
    edges = faces.select("mesh", F.explode(F.array(*(F.struct(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")) for a, b in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))))).alias("e"))
    return edges.select("mesh", "e.*").groupBy("mesh", "a", "b").agg(F.count("*").alias("n")).filter("n = 1").select("mesh", "a", "b")


def terrain_grid(tri: DataFrame, x0: int, y0: int, cell: int, cols: int, rows: int) -> DataFrame:
    """(row, col, height): barycentric height at the cell centres; where faces overlap the last face wins.

    A face meets only the cells of its own box. Heights are doubles of whole-number ratios.
    """
    t = tri.withColumn("_a", area2()).filter("_a != 0")
    first = lambda lo, o: F.greatest(F.lit(0).cast("long"), F.floor((F.least(*lo) - o - cell / 2) / cell).cast("long"))
    last = lambda hi, o, n: F.least(F.lit(n - 1).cast("long"), F.ceil((F.greatest(*hi) - o - cell / 2) / cell).cast("long"))
    t = t.withColumn("_c0", first(("x0", "x1", "x2"), x0)).withColumn("_c1", last(("x0", "x1", "x2"), x0, cols)).withColumn("_r0", first(("y0", "y1", "y2"), y0)).withColumn("_r1", last(("y0", "y1", "y2"), y0, rows))
    t = t.filter("_c0 <= _c1 AND _r0 <= _r1").withColumn("col", F.explode(F.sequence("_c0", "_c1"))).withColumn("row", F.explode(F.sequence("_r0", "_r1")))
    px, py = 2 * x0 + (2 * F.col("col") + 1) * cell, 2 * y0 + (2 * F.col("row") + 1) * cell  # twice the centre
    side = lambda a, b: (F.col(f"x{b}") - F.col(f"x{a}")) * (py - 2 * F.col(f"y{a}")) - (F.col(f"y{b}") - F.col(f"y{a}")) * (px - 2 * F.col(f"x{a}"))
    w0, w1, w2 = side(1, 2), side(2, 0), side(0, 1)
    sign = F.signum(F.col("_a").cast("double"))
    inside = (w0 * sign >= 0) & (w1 * sign >= 0) & (w2 * sign >= 0)
    height = (w0 * F.col("z0") + w1 * F.col("z1") + w2 * F.col("z2")) / (2 * F.col("_a"))
    return t.filter(inside).groupBy("row", "col").agg(F.max_by(height, F.struct("mesh", "fid")).alias("height"))


def clip_polygon(points: list[tuple[float, float, float]], x0: float, x1: float, y0: float, y1: float) -> list[tuple[float, float, float]]:
    """A convex polygon cut to a rectangle, side by side; heights are interpolated along cut edges."""
    for axis, bound, sign in ((0, x0, 1), (0, x1, -1), (1, y0, 1), (1, y1, -1)):
        depth = [sign * (p[axis] - bound) for p in points]
        out = []
        for i, p in enumerate(points):
            j = (i + 1) % len(points)
            if depth[i] >= 0:
                out.append(p)
            if (depth[i] > 0) != (depth[j] > 0) and depth[i] != 0 and depth[j] != 0:
                t = depth[i] / (depth[i] - depth[j])
                cut = [a + t * (b - a) for a, b in zip(p, points[j], strict=True)]
                cut[axis] = bound
                out.append(tuple(cut))
        points = out
    return points


def cut_to_extent(tri: DataFrame, x0: int, x1: int, y0: int, y1: int) -> DataFrame:
    """Triangles inside stay; only crossing ones go to Python, are clipped and split into fans (fid, part, corners)."""
    placed = extent_class(tri, x0, x1, y0, y1)
    names = [f"{a}{k}" for k in range(3) for a in "xyz"]
    inside = placed.filter("place = 'inside'").select("mesh", "fid", F.lit(0).alias("part"), *(F.col(n).cast("double").alias(n) for n in names))

    def clip(batches):
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                poly = clip_polygon([tuple(float(getattr(r, f"{a}{k}")) for a in "xyz") for k in range(3)], x0, x1, y0, y1)
                rows += [(r.mesh, r.fid, i - 1, *poly[0], *poly[i], *poly[i + 1]) for i in range(1, len(poly) - 1)]
            yield pd.DataFrame(rows, columns=["mesh", "fid", "part", *names]).astype({"mesh": "int64", "fid": "int64", "part": "int32"})

    crossing = placed.filter("place = 'crossing'").select("mesh", "fid", *names)
    cut = crossing.mapInPandas(clip, "mesh long, fid long, part int, " + ", ".join(f"{n} double" for n in names))
    return inside.unionByName(cut).filter(area2() != 0)


def mesh_ranges(faces: DataFrame, tree: str = "tree") -> DataFrame:
    """Per tree its run of faces; ``contiguous`` where no other tree's faces lie between."""
    out = faces.groupBy("mesh", tree).agg(F.min("fid").alias("first"), F.max("fid").alias("last"), F.count("*").alias("n"))
    return out.withColumn("contiguous", F.col("last") - F.col("first") + 1 == F.col("n"))
