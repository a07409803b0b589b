"""Cross-tile entity resolution and recovery of orphaned instances.

All counting runs in Spark and leaves one row per pair of instances. The decisions that depend on earlier decisions
(constrained union, greedy cover) run per connected component in ``applyInPandas``: components are independent, so this
equals one global run in the same order.
"""

from __future__ import annotations

import math
from heapq import heapify, heappop, heappush
from itertools import product, starmap

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxstrata.operators import nearest
from voxstrata.operators.components import components
from voxstrata.operators.lineage import cut

PAIR = ("tile", "a", "other", "b")


def pair_counts(points: DataFrame, overlapping: DataFrame, limit2: int) -> DataFrame:
    """(tile, a, other, b) -> n, agree: each later tile's tree point in an overlap counts its nearest tree point of each
    earlier tile there; ``agree`` counts equal semantics."""
    trees = points.filter("inst > 0").select("tile", "pid", "X", "Y", "Z", "inst", "sem")
    o = overlapping
    box = lambda p: (F.col(f"{p}_X") >= F.col("ox0")) & (F.col(f"{p}_X") <= F.col("ox1")) & (F.col(f"{p}_Y") >= F.col("oy0")) & (F.col(f"{p}_Y") <= F.col("oy1"))
    found = nearest.pairs(trees, trees, limit2, where=F.col("b_tile") < F.col("q_tile"))
    found = found.join(o, (F.col("q_tile") == F.col("later")) & (F.col("b_tile") == F.col("earlier"))).filter(box("q") & box("b"))
    best = found.groupBy("q_tile", "q_pid", "b_tile", "q_inst", "q_sem").agg(F.min_by(F.struct("b_inst", "b_sem"), F.struct("d2", "b_pid")).alias("m"))
    out = best.groupBy(F.col("q_tile").alias("tile"), F.col("q_inst").alias("a"), F.col("b_tile").alias("other"), F.col("m.b_inst").alias("b"))
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("q_sem") == F.col("m.b_sem")).alias("agree"))


def overlap_shapes(points: DataFrame, overlapping: DataFrame) -> DataFrame:
    """(tile, other, inst): number and sums of an instance's points in the rectangle that two tiles share."""
    both = overlapping.select(F.col("later").alias("tile"), F.col("earlier").alias("other"), "ox0", "ox1", "oy0", "oy1").unionByName(
        overlapping.select(F.col("earlier").alias("tile"), F.col("later").alias("other"), "ox0", "ox1", "oy0", "oy1")
    )
    joined = points.filter("inst > 0").join(both, "tile").filter("X >= ox0 AND X <= ox1 AND Y >= oy0 AND Y <= oy1")
    return joined.groupBy("tile", "other", "inst").agg(F.count("*").alias("n"), *(F.sum(a).alias(f"s{a.lower()}") for a in "XYZ"))


def mutual_best(pairs: DataFrame) -> DataFrame:
    """Pairs that are each other's best partner in the other tile, neither of them tied."""
    left = Window.partitionBy("tile", "a", "other")
    right = Window.partitionBy("other", "b", "tile")
    ranked = pairs.withColumn("l", F.max("n").over(left)).withColumn("r", F.max("n").over(right))
    ranked = ranked.withColumn("lt", F.sum((F.col("n") == F.col("l")).cast("int")).over(left)).withColumn("rt", F.sum((F.col("n") == F.col("r")).cast("int")).over(right))
    return ranked.filter("n = l AND n = r AND lt = 1 AND rt = 1").select(*pairs.columns)


def match_edges(points: DataFrame, overlapping: DataFrame, limit2: int, *, threshold: float = 0.3, least: int = 10, most_distance: int = 5000) -> DataFrame:
    """Mutual best pairs above the threshold and within the limits, with the squared distance of their overlap centroids."""
    sizes = points.filter("inst > 0").groupBy("tile", "inst").agg(F.count("*").alias("size"))
    shapes = overlap_shapes(points, overlapping)
    side = lambda t, i, o, p: shapes.select(F.col("tile").alias(t), F.col("inst").alias(i), F.col("other").alias(o), *((F.col(f"s{x}") / F.col("n")).alias(f"{p}{x}") for x in "xyz"))
    out = mutual_best(pair_counts(points, overlapping, limit2))
    out = out.join(sizes.select("tile", F.col("inst").alias("a"), F.col("size").alias("size_a")), ["tile", "a"])
    out = out.join(sizes.select(F.col("tile").alias("other"), F.col("inst").alias("b"), F.col("size").alias("size_b")), ["other", "b"])
    out = out.join(side("tile", "a", "other", "l"), ["tile", "a", "other"], "left").join(side("other", "b", "tile", "r"), ["other", "b", "tile"], "left")
    d = sum(((F.col(f"l{x}") - F.col(f"r{x}")) * (F.col(f"l{x}") - F.col(f"r{x}")) for x in "xyz"), F.lit(0.0))
    out = out.withColumn("centroid2", d).filter((F.col("n") >= threshold * F.least("size_a", "size_b")) & (F.col("n") >= least) & (2 * F.col("agree") >= F.col("n")))
    out = out.filter(F.col("centroid2").isNull() | (F.col("centroid2") <= float(most_distance) ** 2) | F.lit(most_distance == 0))
    return out.select(*PAIR, "n", "agree", F.round("centroid2", 3).alias("centroid2"))


def ordered_edges(edges: DataFrame, normal: Column | None = None) -> DataFrame:
    """``place`` of each edge in the order of union: most shared points first; with ``normal`` (a condition), normal
    edges first in key order, then the others by points."""
    keys = [F.col(c) for c in PAIR]
    if normal is None:
        order = [F.desc("n"), *keys]
    else:
        order = [F.when(normal, 0).otherwise(1), F.when(normal, 0).otherwise(-F.col("n")), *keys]
    # one row per surviving pair of instances
    return edges.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def _component_labels(links: DataFrame) -> DataFrame:
    """(node, component) of undirected links (u, v), which may link a node to itself; component is the least node reachable."""
    links = cut(links.select("u", "v").distinct())
    nodes = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).distinct()
    return nodes.join(components(links, cut), "node", "left").select("node", F.coalesce("root", "node").alias("component"))


class _Groups:
    """Labels of tiles that grow into groups; a node is (tile, label), and two nodes are at odds if no group may hold both."""

    def __init__(self, overlaps: set[tuple[int, int]], centers: dict[tuple[int, int, int], tuple[float, float, float]], most: float, normal: set[tuple[int, int]]):
        self.overlaps, self.centers, self.most, self.normal = overlaps, centers, most, normal
        self.home: dict[tuple[int, int], frozenset] = {}

    def of(self, node: tuple[int, int]) -> frozenset:
        return self.home.setdefault(node, frozenset((node,)))

    def at_odds(self, one: tuple[int, int], other: tuple[int, int]) -> bool:
        (t, _), (o, _) = one, other
        if t == o:
            return one != other
        if (max(t, o), min(t, o)) not in self.overlaps:
            return True
        here, there = self.centers.get((*one, o)), self.centers.get((*other, t))
        return bool(self.most) and None not in (here, there) and math.dist(here, there) > self.most

    def join(self, one: tuple[int, int], other: tuple[int, int]) -> None:
        """Makes one group of two nodes' groups, unless members are at odds, or a recovered node's match would bridge two
        groups that each have normal members."""
        mine, theirs = self.of(one), self.of(other)
        bridge = not {one, other} <= self.normal and not mine.isdisjoint(self.normal) and not theirs.isdisjoint(self.normal)
        if mine is theirs or bridge or any(starmap(self.at_odds, product(mine, theirs))):
            return
        self.home.update(dict.fromkeys(mine | theirs, mine | theirs))


def reconciled(points: DataFrame, overlapping: DataFrame, edges: DataFrame, most_distance: int = 5000, normal: DataFrame | None = None) -> DataFrame:
    """(tile, inst) -> group, 1..G by the least member; unions are constrained and ordered.

    ``normal``: the (tile, inst) that were there before recovery. Then edges between them go first, in key order, and no
    other edge joins two groups that hold some. A pair of nodes beyond ``most_distance`` (0: any) never shares a group.
    """
    node = lambda t, i: F.col(t) * (1 << 32) + F.col(i)
    flag = lambda t, i, name: normal.select(F.col("tile").alias(t), F.col("inst").alias(i)).distinct().withColumn(name, F.lit(True))
    if normal is None:
        edges = edges.withColumns({"_a": F.lit(False), "_b": F.lit(False)})
    else:
        edges = edges.join(flag("tile", "a", "_a"), ["tile", "a"], "left").join(flag("other", "b", "_b"), ["other", "b"], "left").fillna(False, ["_a", "_b"])
    edges = cut(edges.select(*PAIR, "n", "_a", "_b"))
    labels = _component_labels(edges.select(node("tile", "a").alias("u"), node("other", "b").alias("v")))
    both = F.col("_a") & F.col("_b")
    tagged = edges.join(labels, node("tile", "a") == F.col("node")).select("component", *PAIR, "_a", "_b", F.when(both, 0).otherwise(1).alias("turn"), F.when(both, 0).otherwise(-F.col("n")).alias("rank"))
    keys = tagged.select("component", F.col("tile"), F.col("a").alias("inst")).unionByName(tagged.select("component", F.col("other").alias("tile"), F.col("b").alias("inst"))).distinct()
    shapes = overlap_shapes(points, overlapping).join(keys, ["tile", "inst"]).select(F.col("component").alias("part"), "tile", "other", "inst", *((F.col(f"s{x}") / F.col("n")).alias(f"c{x}") for x in "xyz"))
    # a component's own part of the layout goes with its shapes: tiles that share an area
    near = keys.select("component", "tile").distinct()
    near = near.join(overlapping.select(F.col("later").alias("tile"), F.col("earlier").alias("other")), "tile").select(F.col("component").alias("part"), "tile", "other", F.lit(None).cast("long").alias("inst"), *(F.lit(None).cast("double").alias(f"c{x}") for x in "xyz"))
    shapes = shapes.unionByName(near)

    def solve(key, e: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        layout = s["inst"].isna()
        centers = {(int(t), int(i), int(o)): (x, y, z) for t, o, i, x, y, z in s.loc[~layout, ["tile", "other", "inst", "cx", "cy", "cz"]].itertuples(index=False)}
        overlaps = set(s.loc[layout, ["tile", "other"]].itertuples(index=False, name=None))
        ends = {(t, a): x for t, a, x in e[["tile", "a", "_a"]].itertuples(index=False)} | {(t, b): x for t, b, x in e[["other", "b", "_b"]].itertuples(index=False)}
        groups = _Groups(overlaps, centers, most_distance, {k for k, x in ends.items() if x})
        for t, a, o, b in e.sort_values(["turn", "rank", *PAIR])[list(PAIR)].itertuples(index=False):
            groups.join((t, a), (o, b))
        return pd.DataFrame([(*k, *min(groups.of(k))) for k in sorted(ends)], columns=["tile", "inst", "root_tile", "root_inst"])

    solved = tagged.groupBy("component").cogroup(shapes.groupBy("part")).applyInPandas(solve, "tile long, inst long, root_tile long, root_inst long")
    every = points.filter("inst > 0").select("tile", "inst").distinct().join(solved, ["tile", "inst"], "left")
    every = every.select("tile", "inst", F.coalesce("root_tile", "tile").alias("rt"), F.coalesce("root_inst", "inst").alias("ri"))
    return every.select("tile", "inst", F.dense_rank().over(Window.orderBy("rt", "ri")).cast("long").alias("group"))


def claims(orphans: DataFrame, retained: DataFrame, limit2: int) -> DataFrame:
    """Distinct locations of rejected instances that no retained tree point covers: (tile, inst, X, Y, Z)."""
    rows = nearest.not_exists_within(orphans.select("tile", "pid", "inst", "X", "Y", "Z"), retained.filter("inst > 0").select("tile", "pid", "X", "Y", "Z"), limit2, ("tile", "pid"))
    return rows.select("tile", "inst", "X", "Y", "Z").dropDuplicates()


def claims_census(claimed: DataFrame) -> DataFrame:
    """Per candidate its locations; ``all_locations`` counts distinct ones over all candidates."""
    total = claimed.select("X", "Y", "Z").distinct().count()
    return claimed.groupBy("tile", "inst").agg(F.count("*").alias("n")).withColumn("all_locations", F.lit(total).cast("long"))


def greedy_cover(claimed: DataFrame, limit2: int, conflicts: DataFrame | None = None) -> DataFrame:
    """(tile, inst, place, score): repeatedly the candidate with most uncovered locations (then the first) is admitted and
    covers every location within reach of any of its own; candidates in ``conflicts`` ((tile, inst) pairs, or pairs with
    an admitted (other, other_inst)) are blocked and never tried again."""
    claimed = cut(claimed)
    loc = claimed.select("X", "Y", "Z").distinct().withColumn("pid", F.xxhash64("X", "Y", "Z"))
    near = nearest.pairs(loc, loc, limit2).select(F.col("q_pid").alias("u"), F.col("b_pid").alias("v"))
    own = claimed.withColumn("pid", F.xxhash64("X", "Y", "Z")).select("tile", "inst", "pid")
    cover = own.join(near, F.col("pid") == F.col("u")).select("tile", "inst", F.col("v").alias("pid")).distinct()
    node = (F.col("tile") * (1 << 32) + F.col("inst")).alias("node")
    shared = cover.select(node, "pid").join(own.select((F.col("tile") * (1 << 32) + F.col("inst")).alias("peer"), "pid"), "pid").select(F.col("node").alias("u"), F.col("peer").alias("v")).distinct()
    if conflicts is not None and "other" in conflicts.columns:
        pair = conflicts.filter("other IS NOT NULL").select((F.col("tile") * (1 << 32) + F.col("inst")).alias("u"), (F.col("other") * (1 << 32) + F.col("other_inst")).alias("v"))
        shared = shared.unionByName(pair)
    labels = _component_labels(shared)
    rows = own.withColumn("kind", F.lit(0)).unionByName(cover.withColumn("kind", F.lit(1)))
    if conflicts is not None:
        single = conflicts.filter("other IS NULL") if "other" in conflicts.columns else conflicts
        rows = rows.join(single.select("tile", "inst").distinct(), ["tile", "inst"], "left_anti")
    if conflicts is not None and "other" in conflicts.columns:
        # who bars whom goes along as rows: the other candidate's node in place of a location
        ends = conflicts.filter("other IS NOT NULL").select("tile", "inst", F.col("other").alias("o"), F.col("other_inst").alias("i"))
        ends = ends.unionByName(ends.select(F.col("o").alias("tile"), F.col("i").alias("inst"), F.col("tile").alias("o"), F.col("inst").alias("i")))
        rows = rows.unionByName(ends.select("tile", "inst", (F.col("o") * (1 << 32) + F.col("i")).alias("pid"), F.lit(2).alias("kind")).distinct())
    rows = rows.withColumn("node", F.col("tile") * (1 << 32) + F.col("inst")).join(labels, "node")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        own, reach, bars = ({k: set(g) for k, g in pdf.loc[pdf["kind"] == kind].groupby(["tile", "inst"])["pid"]} for kind in range(3))
        # scores only fall, so a candidate whose score is still right when it comes up is the best one
        queue = [(-len(places), k) for k, places in own.items()]
        heapify(queue)
        covered, barred, admitted = set(), set(), []
        while queue:
            said, k = heappop(queue)
            score = len(own[k] - covered)
            if score and score < -said:
                heappush(queue, (-score, k))
            elif score and (k[0] << 32) + k[1] not in barred:
                admitted.append((*k, len(admitted) + 1, score))
                covered |= own[k] | reach.get(k, set())
                barred |= bars.get(k, set())
        return pd.DataFrame(admitted, columns=["tile", "inst", "place", "score"]).astype("int64")

    return rows.groupBy("component").applyInPandas(solve, "tile long, inst long, place long, score long")


def supported(claimed: DataFrame, admitted: DataFrame, survivors: DataFrame, limit2: int) -> DataFrame:
    """Per admitted candidate: claimed locations, and how many lie within reach of a surviving tree point."""
    rows = claimed.join(admitted.select("tile", "inst"), ["tile", "inst"], "left_semi").withColumn("pid", F.xxhash64("X", "Y", "Z"))
    held = nearest.within(rows, survivors.filter("inst > 0").select("tile", "pid", "X", "Y", "Z"), limit2, ("tile", "inst", "pid")).withColumn("ok", F.lit(1))
    return rows.join(held, ["tile", "inst", "pid"], "left").groupBy("tile", "inst").agg(F.count("*").alias("claims"), F.count("ok").alias("supported"))


def conflict_edges(candidates: DataFrame, retained: DataFrame, limit2: int) -> DataFrame:
    """Candidates of which any point lies within reach of a retained tree (other is null) or of another candidate."""
    rows = candidates.select("tile", "pid", "inst", "X", "Y", "Z")
    with_kept = nearest.pairs(rows, retained.filter("inst > 0").select("tile", "pid", "X", "Y", "Z"), limit2)
    null = F.lit(None).cast("long")
    kept = with_kept.select(F.col("q_tile").alias("tile"), F.col("q_inst").alias("inst"), null.alias("other"), null.alias("other_inst"))
    among = nearest.pairs(rows, rows, limit2, where=F.struct("q_tile", "q_inst") < F.struct(F.col("b_tile").alias("q_tile"), F.col("b_inst").alias("q_inst")))
    return kept.unionByName(among.select(F.col("q_tile").alias("tile"), F.col("q_inst").alias("inst"), F.col("b_tile").alias("other"), F.col("b_inst").alias("other_inst"))).distinct()
