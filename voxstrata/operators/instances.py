"""Labelled instances: checks, statistics, anchors, and identifier dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxstrata.functions.lattice import half_even

UINT32 = (1 << 32) - 1


def violations(points: DataFrame, label: str = "inst", no_data: int | None = None) -> DataFrame:
    """Counts of labels that are missing, negative, fractional, too large, or the declared no-data value."""
    c = F.col(label).cast("double")
    bad = {"missing": c.isNull() | F.isnan(c), "negative": c < 0, "fractional": c != F.floor(c), "too_large": c > UINT32, "no_data": (c == no_data) if no_data is not None else F.lit(False)}
    return points.agg(*(F.count_if(v).alias(k) for k, v in bad.items()), F.count("*").alias("total"))


def statistics(points: DataFrame, keys: tuple[str, ...] = ("inst",), *, background: bool = False) -> DataFrame:
    """Mergeable per-instance statistics: count, box, sums; and the box's volume."""
    rows = points if background else points.filter("inst > 0")
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), *(f(a).alias(f"{n}_{a.lower()}") for a in "XYZ" for f, n in ((F.min, "min"), (F.max, "max"), (F.sum, "sum"))))
    side = [F.col(f"max_{a}") - F.col(f"min_{a}") for a in "xyz"]
    return out.withColumn("volume", side[0] * side[1] * side[2])


def summary(points: DataFrame, alias: DataFrame) -> DataFrame:
    """Statistics after folding aliases (inst -> target), with the folded identifiers in order."""
    folded = points.filter("inst > 0").join(alias.select("inst", "target"), "inst", "left").withColumn("id", F.coalesce("target", "inst"))
    out = folded.groupBy("id").agg(F.count("*").alias("n"), F.sort_array(F.collect_set(F.when(F.col("inst") != F.col("id"), F.col("inst")))).alias("folded"))
    return out.select(F.col("id").alias("inst"), "n", F.array_join(F.transform("folded", lambda x: x.cast("string")), ",").alias("reassigned_from"))


def anchors(points: DataFrame, kind: str, keys: tuple[str, ...] = ("inst",)) -> DataFrame:
    """Per instance its anchor: the (rounded) XY centroid, or the highest or lowest point; the first in source order wins."""
    groups = points.filter("inst > 0").groupBy(*keys)
    if kind == "centroid":
        sums = groups.agg(F.count("*").alias("n"), F.sum("X").alias("sx"), F.sum("Y").alias("sy"))
        return sums.select(*keys, half_even("sx", "n").alias("ax"), half_even("sy", "n").alias("ay"))
    z = {"highest": -F.col("Z"), "lowest": F.col("Z")}[kind]
    best = groups.agg(F.min_by(F.struct("X", "Y"), F.struct(z.alias("z"), F.col("pid"))).alias("p"))
    return best.select(*keys, F.col("p.X").alias("ax"), F.col("p.Y").alias("ay"))


def majority(points: DataFrame, keys: tuple[str, ...] = ("inst",), value: str = "sem") -> DataFrame:
    """The most frequent value per instance, the least on ties."""
    counts = points.filter("inst > 0").groupBy(*keys, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct((-F.col("n")).alias("n"), F.col(value))).alias(value), F.max("n").alias("votes"))


def reused(points: DataFrame, gap: int) -> DataFrame:
    """Identifiers used in several files whose boxes lie more than ``gap`` apart: they name different things."""
    boxes = points.filter("inst > 0").groupBy("inst", "file").agg(*(f(a).alias(f"{n}{a}") for a in "XY" for f, n in ((F.min, "lo"), (F.max, "hi"))))
    apart = lambda a: F.greatest(F.max(f"lo{a}") - F.min(f"hi{a}"), F.lit(0))
    out = boxes.groupBy("inst").agg(F.count("*").alias("files"), (apart("X") * apart("X") + apart("Y") * apart("Y")).alias("gap2"))
    return out.withColumn("reused", F.col("gap2") > gap * gap)


def reuse_check(points: DataFrame, gap: int, least: int = 10, share: float = 0.05) -> DataFrame:
    """One row: how many identifiers are reused, and whether that is more than is allowed."""
    out = reused(points, gap).agg(F.count("*").alias("instances"), F.count_if("reused").alias("reused"))
    return out.withColumn("failed", F.col("reused") > F.greatest(F.lit(float(least)), F.col("instances") * share))


def wide(points: DataFrame, most: int) -> DataFrame:
    """Instances whose XY box is wider than ``most`` on a side."""
    s = statistics(points)
    return s.filter((F.col("max_x") - F.col("min_x") > most) | (F.col("max_y") - F.col("min_y") > most)).select("inst", "n", "min_x", "max_x", "min_y", "max_y")


def ids_per_file(points: DataFrame) -> DataFrame:
    return points.filter("inst > 0").select("file", "inst").distinct()


def compact(points: DataFrame, alias: DataFrame | None = None) -> DataFrame:
    """Dictionary (inst, new): aliases folded, then 1..N in order; background stays 0.

    The ranking window holds distinct identifiers only.
    """
    ids = points.filter("inst > 0").select("inst").distinct()
    if alias is not None:
        ids = ids.join(alias.select("inst", "target"), "inst", "left").withColumn("root", F.coalesce("target", "inst"))
    else:
        ids = ids.withColumn("root", F.col("inst"))
    return ids.select("inst", F.dense_rank().over(Window.orderBy("root")).cast("long").alias("new"))


def mapped(points: DataFrame, mapping: DataFrame, keys: tuple[str, ...] = ("inst",), to: str = "new", label: str = "inst") -> DataFrame:
    """Labels through a dictionary: 0 stays 0, a label that the dictionary lacks is an error."""
    out = points.join(mapping.select(*keys, to), list(keys), "left")
    missing = F.raise_error(F.concat(F.lit("no mapping for label "), F.col(label).cast("string"))).cast("long")
    return out.withColumn(to, F.when(F.col(label) == 0, F.lit(0).cast("long")).when(F.col(to).isNull(), missing).otherwise(F.col(to)))


def tile_counts(points: DataFrame) -> DataFrame:
    return points.filter("inst > 0").groupBy("inst", "tile").agg(F.count("*").alias("n"), F.sum("X").alias("sx"), F.sum("Y").alias("sy"))


def owner_plan(points: DataFrame, tiles: DataFrame) -> DataFrame:
    """For instances in several tiles: the owner is the first of their tiles whose closed core holds the centroid,
    else the one with most points (then the first)."""
    per = tile_counts(points)
    w = Window.partitionBy("inst")
    held = per.withColumn("N", F.sum("n").over(w)).withColumn("SX", F.sum("sx").over(w)).withColumn("SY", F.sum("sy").over(w)).withColumn("parts", F.count("*").over(w)).filter("parts > 1")
    joined = held.join(tiles.select("tile", "x0", "x1", "y0", "y1"), "tile")
    inside = (F.col("SX") >= F.col("x0") * F.col("N")) & (F.col("SX") <= F.col("x1") * F.col("N")) & (F.col("SY") >= F.col("y0") * F.col("N")) & (F.col("SY") <= F.col("y1") * F.col("N"))
    best = joined.groupBy("inst").agg(F.min(F.when(inside, F.col("tile"))).alias("core"), F.min_by("tile", F.struct((-F.col("n")).alias("n"), F.col("tile"))).alias("most"), F.max("parts").alias("parts"))
    return best.select("inst", F.coalesce("core", "most").alias("owner"), "parts")


def consolidate(points: DataFrame, plan: DataFrame) -> DataFrame:
    """Every point of a split instance moves to its owner tile; nothing is dropped."""
    out = points.join(plan.select("inst", "owner"), "inst", "left")
    return out.withColumn("from_tile", F.col("tile")).withColumn("tile", F.coalesce("owner", "tile")).drop("owner")


def moved(consolidated: DataFrame) -> DataFrame:
    return consolidated.filter("tile != from_tile").groupBy("tile").agg(F.count("*").alias("moved"))


def split_instances(points: DataFrame) -> DataFrame:
    """Instances that lie in more than one tile."""
    return points.filter("inst > 0").groupBy("inst").agg(F.countDistinct("tile").alias("tiles")).filter("tiles > 1")


def small(points: DataFrame, most_points: int, most_volume: int) -> DataFrame:
    """Statistics with ``small``: fewer points and a smaller box than the limits, both strictly."""
    return statistics(points).withColumn("small", (F.col("n") < most_points) & (F.col("volume") < most_volume))


def small_plan(points: DataFrame, most_points: int, most_volume: int, reach: int) -> DataFrame:
    """(inst, target) for small instances: the nearest XY centroid among the others, if within reach; never a small one.

    Instances meet instances: a grid of the reach's width keeps it an equi-join.
    """
    s = small(points, most_points, most_volume).withColumn("cx", F.col("sum_x") / F.col("n")).withColumn("cy", F.col("sum_y") / F.col("n"))
    cell = lambda c: F.floor(F.col(c) / reach)
    around = lambda c: F.explode(F.array(c - 1, c, c + 1))
    a = s.filter("small").select("inst", F.col("cx").alias("ax"), F.col("cy").alias("ay"), around(cell("cx")).alias("gx"), cell("cy").alias("gy0")).withColumn("gy", around(F.col("gy0"))).drop("gy0")
    b = s.filter("NOT small").select(F.col("inst").alias("target"), "cx", "cy", cell("cx").alias("gx"), cell("cy").alias("gy"))
    d = (F.col("ax") - F.col("cx")) * (F.col("ax") - F.col("cx")) + (F.col("ay") - F.col("cy")) * (F.col("ay") - F.col("cy"))
    near = a.join(b, ["gx", "gy"]).withColumn("d2", d).filter(F.col("d2") <= float(reach) * reach)
    return near.groupBy("inst").agg(F.min_by("target", F.struct("d2", "target")).alias("target"))


def nearest_centroids(points: DataFrame, k: int) -> DataFrame:
    """The k nearest other centroids of each instance (3-D). One row an instance meets all others: instances, not points."""
    s = statistics(points).select("inst", *((F.col(f"sum_{a}") / F.col("n")).alias(a) for a in "xyz"))
    a, b = s.alias("a"), s.alias("b")
    d = sum(((F.col(f"a.{x}") - F.col(f"b.{x}")) * (F.col(f"a.{x}") - F.col(f"b.{x}")) for x in "xyz"), F.lit(0.0))
    near = a.join(b, F.col("a.inst") != F.col("b.inst")).select(F.col("a.inst").alias("inst"), F.col("b.inst").alias("other"), d.alias("d2"))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("inst").orderBy("d2", "other")))
    return ranked.filter(F.col("rank") <= k).select("inst", "other", "rank", F.sqrt("d2").alias("distance"))


def is_ground(label: Column, *, viewer: bool = False) -> Column:
    return label <= 0 if viewer else label == 0
