"""Tile grids: layouts, neighbours, overlaps, and which tile a point belongs to.

A layout is a table: tile, col, row, and the core and buffered rectangles in lattice units. A regular one is a ``Frame``,
a few numbers, from which points find their tiles by arithmetic, without a join. Other layouts (with holes) join by
column and row; their size is known to the optimizer, which broadcasts small ones only, so no number of tiles is too many.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxstrata.functions.lattice import exact_div, floor_div, rect_distance2
from voxstrata.operators.lineage import cut


def extent(points: DataFrame) -> DataFrame:
    """One row: bounds and number of points."""
    return points.agg(*(f(c).alias(f"{n}_{c.lower()}") for c in ("X", "Y", "Z") for f, n in ((F.min, "min"), (F.max, "max"))), F.count("*").alias("n"))


def headers(points: DataFrame) -> DataFrame:
    """The extent of each file."""
    return points.groupBy("file").agg(*(f(c).alias(f"{n}_{c.lower()}") for c in ("X", "Y", "Z") for f, n in ((F.min, "min"), (F.max, "max"))), F.count("*").alias("n"))


@dataclass(frozen=True)
class Frame:
    """A regular layout: its origin, tiles by axis, tile length and buffer, in lattice units. Tiles are numbered column by column."""

    x: int
    y: int
    cols: int
    rows: int
    length: int
    buffer: int

    def tiles(self, spark: SparkSession) -> DataFrame:
        """One row a tile, made where it is used."""
        n, length, buffer = self.cols * self.rows, self.length, self.buffer
        numbered = spark.range(n).select(F.col("id").alias("tile"), exact_div(F.col("id") - F.pmod("id", F.lit(max(1, self.rows))), F.lit(max(1, self.rows))).alias("col"), F.pmod("id", F.lit(max(1, self.rows))).cast("long").alias("row"))
        x0, y0 = F.col("col") * length + self.x, F.col("row") * length + self.y
        return numbered.select(
            "tile", "col", "row", x0.alias("x0"), (x0 + length).alias("x1"), y0.alias("y0"), (y0 + length).alias("y1"),
            (x0 - buffer).alias("bx0"), (x0 + length + buffer).alias("bx1"), (y0 - buffer).alias("by0"), (y0 + length + buffer).alias("by1"),
        )

    def assign(self, points: DataFrame, reach: int) -> DataFrame:
        """Each point once for every tile whose closed core, grown by ``reach``, holds it; ``tile`` comes first."""
        for name, axis, origin, count in (("_c", "X", self.x, self.cols), ("_r", "Y", self.y, self.rows)):
            first = F.greatest(floor_div(F.col(axis) - (origin + reach + 1), self.length), F.lit(0).cast("long"))
            last = F.least(floor_div(F.col(axis) - (origin - reach), self.length), F.lit(count - 1).cast("long"))
            points = points.withColumns({"_a": first, "_b": last}).filter("_a <= _b").withColumn(name, F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
        names = [c for c in points.columns if c not in ("_c", "_r")]
        return points.select((F.col("_c") * self.rows + F.col("_r")).alias("tile"), *names)


def frame(points: DataFrame, length: int, buffer: int) -> Frame:
    """The layout over the points' extent (one row to the driver): as many tiles an axis as cover it, one at least; none for no points."""
    e = points.agg(*(f(c).alias(f"{n}_{c.lower()}") for c in ("X", "Y") for f, n in ((F.min, "min"), (F.max, "max")))).first()
    if e.min_x is None or e.min_y is None:
        return Frame(0, 0, 0, 0, length, buffer)
    count = lambda lo, hi: max(1, -((lo - hi) // length))
    return Frame(e.min_x, e.min_y, count(e.min_x, e.max_x), count(e.min_y, e.max_y), length, buffer)


def tile_grid(points: DataFrame, length: int, buffer: int) -> DataFrame:
    """The rows of ``frame``."""
    return frame(points, length, buffer).tiles(points.sparkSession)


def neighbors(tiles: DataFrame) -> DataFrame:
    """Per tile its east, west, north and south neighbour or null, by column and row."""
    out = tiles.select("tile", "col", "row")
    for name, dc, dr in (("east", 1, 0), ("west", -1, 0), ("north", 0, 1), ("south", 0, -1)):
        side = tiles.select((F.col("col") - dc).alias("col"), (F.col("row") - dr).alias("row"), F.col("tile").alias(name))
        out = out.join(side, ["col", "row"], "left")
    return out.select("tile", "east", "west", "north", "south")


def nearest_neighbors(tiles: DataFrame) -> DataFrame:
    """Neighbours of layouts without columns and rows: the nearest centre on each side among those that overlap it in the other axis."""
    a, b = tiles.alias("a"), tiles.alias("b")
    pair = a.join(b, F.col("a.tile") != F.col("b.tile"))  # a layout against itself: tiles, not points
    cx, cy = (F.col("b.x0") + F.col("b.x1") - F.col("a.x0") - F.col("a.x1")), (F.col("b.y0") + F.col("b.y1") - F.col("a.y0") - F.col("a.y1"))
    wide = (F.least("a.x1", "b.x1") > F.greatest("a.x0", "b.x0"))
    tall = (F.least("a.y1", "b.y1") > F.greatest("a.y0", "b.y0"))
    sides = {"east": tall & (cx > 0), "west": tall & (cx < 0), "north": wide & (cy > 0), "south": wide & (cy < 0)}
    key = F.struct((cx * cx + cy * cy).alias("d"), F.col("b.tile").alias("t"))
    found = pair.groupBy(F.col("a.tile").alias("tile")).agg(*(F.min(F.when(c, key))["t"].alias(n) for n, c in sides.items()))
    return tiles.select("tile").join(found, "tile", "left")


def overlaps(tiles: DataFrame) -> DataFrame:
    """(later, earlier, rectangle) for buffered rectangles of a grid's tiles that share an area.

    A tile meets those at most ``ceil(buffered length / length) - 1`` columns and rows away, by an equi-join.
    """
    reach = lambda x: F.ceil((F.col(f"b{x}1") - F.col(f"b{x}0")) / (F.col(f"{x}1") - F.col(f"{x}0"))).cast("long") - 1
    a = tiles
    for name, x in (("col", "x"), ("row", "y")):
        a = a.withColumn("_step", F.explode(F.sequence(-reach(x), reach(x)))).withColumn(f"_{name}", F.col(name) + F.col("_step")).drop("_step")
    a, b = a.alias("a"), tiles.alias("b")
    lo = {x: F.greatest(f"a.b{x}0", f"b.b{x}0") for x in "xy"}
    hi = {x: F.least(f"a.b{x}1", f"b.b{x}1") for x in "xy"}
    near = (F.col("a._col") == F.col("b.col")) & (F.col("a._row") == F.col("b.row"))
    pairs = a.join(b, near & (F.col("b.tile") < F.col("a.tile")) & (hi["x"] > lo["x"]) & (hi["y"] > lo["y"]))
    return pairs.select(F.col("a.tile").alias("later"), F.col("b.tile").alias("earlier"), lo["x"].alias("ox0"), hi["x"].alias("ox1"), lo["y"].alias("oy0"), hi["y"].alias("oy1"))


def in_rect(x: Column, y: Column, x0: str, x1: str, y0: str, y1: str) -> Column:
    """Inclusive on all sides."""
    return (x >= F.col(x0)) & (x <= F.col(x1)) & (y >= F.col(y0)) & (y <= F.col(y1))


def _candidates(points: DataFrame, tiles: DataFrame, length: int, reach: int) -> DataFrame:
    """Points with every (col, row) whose rectangle grown by ``reach`` may hold them: an equi-join by column and row follows."""
    origin = tiles.agg(F.min("x0").alias("_ox"), F.min("y0").alias("_oy"))  # one row
    axis = lambda v, o: F.sequence(floor_div(F.col(v) - reach - F.col(o) - 1, length), floor_div(F.col(v) + reach - F.col(o), length))
    near = points.join(F.broadcast(origin))
    near = near.withColumn("col", F.explode(axis("X", "_ox")))
    return near.withColumn("row", F.explode(axis("Y", "_oy"))).drop("_ox", "_oy")


def assign_buffered(points: DataFrame, tiles: DataFrame | Frame, length: int, buffer: int) -> DataFrame:
    """Each point once for every tile whose closed buffered rectangle holds it."""
    if isinstance(tiles, Frame):
        return tiles.assign(points, buffer)
    joined = _candidates(points, tiles, length, buffer).join(tiles, ["col", "row"])
    return joined.filter(in_rect(F.col("X"), F.col("Y"), "bx0", "bx1", "by0", "by1")).select("tile", *points.columns)


def in_cores(points: DataFrame, tiles: DataFrame | Frame, length: int) -> DataFrame:
    """Each point once for every tile whose closed core holds it (two or four on shared borders)."""
    if isinstance(tiles, Frame):
        return tiles.assign(points, 0)
    joined = _candidates(points, tiles, length, 0).join(tiles, ["col", "row"])
    return joined.filter(in_rect(F.col("X"), F.col("Y"), "x0", "x1", "y0", "y1")).select("tile", *points.columns)


def core_occupancy(points: DataFrame, tiles: DataFrame | Frame, length: int) -> DataFrame:
    """Points in each planned tile's core; tiles without any have 0 and aren't kept."""
    counts = in_cores(points, tiles, length).groupBy("tile").agg(F.count("*").alias("n"))
    planned = tiles.tiles(points.sparkSession) if isinstance(tiles, Frame) else tiles
    out = planned.select("tile").join(counts, "tile", "left").select("tile", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return out.withColumn("kept", F.col("n") > 0)


def uncovered(points: DataFrame, tiles: DataFrame, length: int) -> DataFrame:
    """Points that no core holds."""
    return points.join(in_cores(points, tiles, length).select("pid").distinct(), "pid", "left_anti")


def owner_core(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """Per point (pid) the first closed core in tile order that holds it, else the nearest core (then the first).

    Points in a core find it by their cell. The others look into rings of cells around their own, twice as wide each
    round, and stop as soon as no core outside of the ring can be as near; a ring never leaves the layout's range.
    """
    wide, tall = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    f = tiles.agg(
        F.max(wide).alias("w"), F.max(tall).alias("h"), F.min(F.col("x0") - F.col("col") * wide).alias("x"), F.min(F.col("y0") - F.col("row") * tall).alias("y"),
        F.min("col").alias("c0"), F.max("col").alias("c1"), F.min("row").alias("r0"), F.max("row").alias("r1"),
    ).first()
    if f.w is None:
        return points.select("pid", F.lit(None).cast("long").alias("owner"), F.lit(None).cast("long").alias("d2")).limit(0)
    d = rect_distance2(F.col("X"), F.col("Y"), F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1"))
    rest, done, ring = points.select("pid", "X", "Y"), None, 0
    own_c, own_r = floor_div(F.col("X") - f.x, f.w), floor_div(F.col("Y") - f.y, f.h)
    low = lambda at, back, least: F.greatest(at - back, F.lit(least))
    high = lambda at, on, most: F.least(at + on, F.lit(most))
    while True:
        # a core that ends where the point lies is the one before: it holds the point as well
        back = 1 if ring == 0 else ring
        cells = rest.withColumns({"_a": low(own_c, back, f.c0), "_b": high(own_c, ring, f.c1), "_d": low(own_r, back, f.r0), "_e": high(own_r, ring, f.r1)})
        cells = cells.filter("_a <= _b AND _d <= _e").withColumn("col", F.explode(F.sequence("_a", "_b"))).withColumn("row", F.explode(F.sequence("_d", "_e")))
        near = cells.join(tiles.select("tile", "col", "row", "x0", "x1", "y0", "y1"), ["col", "row"])
        best = near.groupBy("pid").agg(F.min(F.struct(d.alias("d2"), F.col("tile"))).alias("best"))
        sure = F.col("best.d2") < (ring * min(f.w, f.h)) ** 2 if ring else F.col("best.d2") == 0
        whole = (own_c - ring <= f.c0) & (own_c + ring >= f.c1) & (own_r - ring <= f.r0) & (own_r + ring >= f.r1)
        seen = cut(rest.join(best, "pid", "left").withColumn("_sure", F.coalesce(sure | whole, F.lit(False))))
        found = seen.filter("_sure").select("pid", F.col("best.tile").alias("owner"), F.col("best.d2").alias("d2"))
        done = found if done is None else done.unionByName(found)
        rest = seen.filter("NOT _sure").select("pid", "X", "Y")
        if rest.isEmpty():
            return done
        ring = max(1, 2 * ring)


def owned_background(assigned: DataFrame, tiles: DataFrame, linked: DataFrame) -> DataFrame:
    """Background points kept by a tile: half-open cores, the east or north tile owns a shared border; outer sides are open ended."""
    t = tiles.join(linked, "tile")
    joined = assigned.join(t, "tile")
    inside = (
        (F.col("west").isNull() | (F.col("X") >= F.col("x0"))) & (F.col("east").isNull() | (F.col("X") < F.col("x1")))
        & (F.col("south").isNull() | (F.col("Y") >= F.col("y0"))) & (F.col("north").isNull() | (F.col("Y") < F.col("y1")))
    )
    return joined.filter(inside).select(*assigned.columns)


def owned_anchors(anchors: DataFrame, tiles: DataFrame, linked: DataFrame, x: str = "ax", y: str = "ay") -> DataFrame:
    """Anchors that a tile owns: its closed core, clipped only where it has a neighbour."""
    joined = anchors.join(tiles.join(linked, "tile"), "tile")
    inside = (
        (F.col("west").isNull() | (F.col(x) >= F.col("x0"))) & (F.col("east").isNull() | (F.col(x) <= F.col("x1")))
        & (F.col("south").isNull() | (F.col(y) >= F.col("y0"))) & (F.col("north").isNull() | (F.col(y) <= F.col("y1")))
    )
    return joined.filter(inside).select(*anchors.columns)


def layout_rows(spark: SparkSession, path: str) -> DataFrame:
    """A layout document ({tiles: [{bounds, core, col, row}]}) as rows, in document order."""
    doc = spark.read.json(path, multiLine=True)
    rows = doc.select(F.posexplode("tiles").alias("tile", "t"))
    side = lambda which, i, j: F.col(f"t.{which}")[i][j].cast("double")
    return rows.select("tile", "t.col", "t.row", *(side(w, i, j).alias(f"{p}{a}{j}") for w, p in (("core", ""), ("bounds", "b")) for i, a in enumerate("xy") for j in (0, 1)))


def match_files(files: list[tuple], tiles: list[tuple], steps: tuple[float, ...] = (0.1, 0.5, 1.0, 2.0, 5.0)) -> dict[int, int]:
    """Files to tiles of a layout by their bounds (x0, x1, y0, y1): with a growing tolerance on all four sides, each file
    takes the free tile of least total difference; files left over take the free tile of nearest centre that holds theirs.

    Both lists are a layout's, so this runs on the driver. Unmatched files are absent from the result.
    """
    taken: dict[int, int] = {}
    free = set(range(len(tiles)))

    def take(i: int, scored: list[tuple]) -> None:
        if scored:
            taken[i] = min(scored)[1]
            free.discard(taken[i])

    for step in steps:
        for i, f in enumerate(files):
            if i not in taken:
                gaps = {t: [abs(a - b) for a, b in zip(f, tiles[t], strict=True)] for t in free}
                take(i, [(sum(g), t) for t, g in gaps.items() if max(g) <= step])
    for i, f in enumerate(files):
        if i not in taken:
            cx, cy = (f[0] + f[1]) / 2, (f[2] + f[3]) / 2
            inside = [t for t in free if tiles[t][0] <= cx <= tiles[t][1] and tiles[t][2] <= cy <= tiles[t][3]]
            take(i, [((cx - sum(tiles[t][:2]) / 2) ** 2 + (cy - sum(tiles[t][2:]) / 2) ** 2, t) for t in inside])
    return taken


def instance_tiles(points: DataFrame, tiles: DataFrame, resolution: int) -> DataFrame:
    """Whole instances in the tile that owns their (rounded) centroid, background by point, one representative per
    instance and voxel; resolution 0 keeps all points."""
    from voxstrata.operators import instances, voxel

    centers = instances.anchors(points, "centroid").select(F.col("inst").alias("pid"), F.col("ax").alias("X"), F.col("ay").alias("Y"))
    trees = points.filter("inst > 0").join(owner_core(centers, tiles).select(F.col("pid").alias("inst"), F.col("owner").alias("tile")), "inst")
    ground = points.filter("inst = 0")
    ground = ground.join(owner_core(ground, tiles).select("pid", F.col("owner").alias("tile")), "pid")
    rows = trees.select("tile", *points.columns).unionByName(ground.select("tile", *points.columns))
    return rows if resolution == 0 else voxel.representatives(rows, resolution, ("tile", "inst"), ("X", "Y", "Z", "pid"))
