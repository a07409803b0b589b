"""Small scenes with known answers, boundary distances, partition independence, and failures."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxstrata.operators import coloring, components, grid, instances, mesh, nearest, octree, ownership, product, reconcile, voxel

POINT = "tile long, pid long, X long, Y long, Z long, inst long, sem long"


def cloud(spark, rows):
    return spark.createDataFrame(rows, POINT)


@pytest.mark.parametrize("gap,hit", [(9, True), (10, True), (11, False)])
def test_radius_is_inclusive(spark, gap, hit):
    a, b = cloud(spark, [(0, 1, 0, 0, 0, 1, 0)]), cloud(spark, [(0, 2, gap, 0, 0, 1, 0)])
    assert (nearest.nearest(a, b, 100, ("pid",)).count() == 1) is hit
    assert (nearest.exists_within(a, b, 100, ("pid",)).count() == 1) is hit
    assert (nearest.not_exists_within(a, b, 100, ("pid",)).count() == 0) is hit


def test_nearest_ties_go_to_the_first_tile_and_point(spark):
    a = cloud(spark, [(0, 1, 0, 0, 0, 0, 0)])
    b = cloud(spark, [(2, 5, 3, 0, 0, 1, 0), (1, 9, -3, 0, 0, 2, 0), (1, 8, 0, 3, 0, 3, 0)])
    for parts in (1, 7):
        r = nearest.nearest(a, b.repartition(parts), 100, ("pid",)).first()
        assert (r.b_tile, r.b_pid, r.d2) == (1, 8, 9)


def test_results_do_not_depend_on_partitions(spark):
    rnd = random.Random(3)
    rows = [(0, i, *(rnd.randrange(-60, 60) for _ in range(3)), rnd.randrange(4), 0) for i in range(300)]
    rnd.shuffle(rows)
    base = None
    for parts in (1, 5):
        p = cloud(spark, rows).repartition(parts)
        got = sorted(map(tuple, voxel.representatives(p, 25, ties=("X", "Y", "Z", "pid")).collect())), sorted(map(tuple, voxel.centers(p, 25).collect()))
        base = base or got
        assert got == base


def test_shared_borders_belong_to_all_closed_cores_and_one_half_open(spark):
    p = cloud(spark, [(0, 1, 0, 0, 0, 0, 0), (0, 2, 10, 5, 0, 0, 0), (0, 3, 20, 10, 0, 0, 0)])
    tiles = grid.tile_grid(p, 10, 2)
    assert tiles.count() == 2
    assert sorted((r.tile, r.pid) for r in grid.in_cores(p.drop("tile"), tiles, 10).collect()) == [(0, 1), (0, 2), (1, 2), (1, 3)]
    kept = grid.owned_background(grid.assign_buffered(p.drop("tile"), tiles, 10, 2), tiles, grid.neighbors(tiles))
    assert sorted((r.tile, r.pid) for r in kept.collect()) == [(0, 1), (1, 2), (1, 3)]


def brute_dedup(rows, limit2, level):
    alive = []
    for tile in sorted({r[0] for r in rows}):
        now = [r for r in rows if r[0] == tile]
        drop = set()
        for r in now:
            near = [(sum((a - b) ** 2 for a, b in zip(r[2:5], o[2:5])), o[0], o[1], o) for o in alive if o[0] in level.get(tile, ())]
            near = [x for x in near if x[0] <= limit2]
            if near and min(near)[3][5:] == r[5:]:
                drop.add(r[1])
        alive += [r for r in now if r[1] not in drop]
    return {(r[0], r[1]) for r in alive}


def test_deduplicate_waves_equal_a_sequential_pass(spark):
    rnd = random.Random(5)
    rows = [(t, i, rnd.randrange(12), rnd.randrange(12), 0, rnd.randrange(2), 0) for t in range(3) for i in range(25)]
    pairs = [(b, a) for a, b in itertools.combinations(range(3), 2)]
    got = ownership.deduplicate(cloud(spark, rows), spark.createDataFrame(pairs, "later long, earlier long"), 4)
    assert {(r.tile, r.pid) for r in got.collect()} == brute_dedup(rows, 4, {0: (), 1: (0,), 2: (0, 1)})


def brute_greedy(claims, limit2):
    near = lambda p, q: sum((a - b) ** 2 for a, b in zip(p, q)) <= limit2
    covered, out, left = set(), [], dict(claims)
    while True:
        scored = sorted((-len(v - covered), k) for k, v in left.items())
        if not scored or not scored[0][0]:
            return out
        k = scored[0][1]
        everywhere = set().union(*claims.values())
        out.append((*k, -scored[0][0]))
        covered |= {p for p in everywhere if any(near(p, q) for q in left[k])}
        del left[k]


@pytest.mark.parametrize("seed", range(2))
def test_greedy_cover_equals_full_rescoring(spark, seed):
    rnd = random.Random(seed)
    places = [(6 * i, 0, 0) for i in range(12)]
    claims = {(t, i): set(rnd.sample(places, 4)) for t in range(2) for i in range(1, 4)}
    rows = [(*k, *p) for k, v in claims.items() for p in v]
    got = reconcile.greedy_cover(spark.createDataFrame(rows, "tile long, inst long, X long, Y long, Z long"), 36)
    assert sorted((r.tile, r.inst, r.score) for r in got.collect()) == sorted(brute_greedy(claims, 36))


def test_union_refuses_two_labels_of_one_tile(spark):
    # 1 of tile 0 matches 1 of tile 1 (stronger) and 1 of tile 2; 2 of tile 2 matches 1 of tile 1
    edges = spark.createDataFrame([(1, 1, 0, 1, 9, 9, 0.0), (2, 1, 0, 1, 8, 8, 0.0), (2, 2, 1, 1, 5, 5, 0.0)], "tile long, a long, other long, b long, n long, agree long, centroid2 double")
    p = cloud(spark, [(0, 1, 0, 0, 0, 1, 0), (1, 2, 0, 0, 0, 1, 0), (2, 3, 0, 0, 0, 1, 0), (2, 4, 0, 0, 0, 2, 0)])
    o = spark.createDataFrame([(1, 0), (2, 0), (2, 1)], "later long, earlier long").selectExpr("later", "earlier", "-9L ox0", "9L ox1", "-9L oy0", "9L oy1")
    got = {(r.tile, r.inst): r.group for r in reconcile.reconciled(p, o, edges).collect()}
    assert got == {(0, 1): 1, (1, 1): 1, (2, 1): 1, (2, 2): 2}


def brute_groups(nodes, edges, normal, overlaps, center, most):
    """Groups as sets of nodes, merged in edge order by the rules."""
    groups = {k: {k} for k in nodes}
    order = lambda e: (0, 0, e[:4]) if {e[:2], e[2:4]} <= normal else (1, -e[4], e[:4])
    for t, a, o, b, _ in sorted(edges, key=order):
        x, y = groups[t, a], groups[o, b]
        ok = x is not y
        for p in x:
            for q in y:
                ok = ok and p[0] != q[0] and (max(p[0], q[0]), min(p[0], q[0])) in overlaps and sum((m - n) ** 2 for m, n in zip(center[p], center[q])) <= most**2
        if ok and x & normal and y & normal and not {(t, a), (o, b)} <= normal:
            ok = False
        if ok:
            x |= y
            for k in y:
                groups[k] = x
    return {k: min(v) for k, v in groups.items()}


@pytest.mark.parametrize("with_normal", [False, True])
@pytest.mark.parametrize("seed", range(2))
def test_groups_equal_a_plain_pass(spark, seed, with_normal):
    rnd = random.Random(seed)
    nodes = [(t, i) for t in range(5) for i in range(1, 5)]
    center = {k: (rnd.randrange(40), rnd.randrange(40), 0) for k in nodes}
    overlaps = {(b, a) for a, b in itertools.combinations(range(5), 2) if rnd.random() < 0.8}
    edges = [(t, a, o, b, rnd.randrange(1, 9)) for t, a in nodes for o, b in nodes if o < t and rnd.random() < 0.25]
    normal = {k for k in nodes if rnd.random() < 0.5} if with_normal else set()
    p = cloud(spark, [(t, 10 * t + i, *center[t, i], i, 0) for t, i in nodes])
    o = spark.createDataFrame(sorted(overlaps), "later long, earlier long").selectExpr("later", "earlier", "-99L ox0", "99L ox1", "-99L oy0", "99L oy1")
    e = spark.createDataFrame(edges, "tile long, a long, other long, b long, n long")
    keys = spark.createDataFrame(sorted(normal), "tile long, inst long") if with_normal else None
    got = {(r.tile, r.inst): r.group for r in reconcile.reconciled(p, o, e, 30, keys).collect()}
    want = brute_groups(nodes, edges, normal, overlaps, center, 30)
    number = {root: i + 1 for i, root in enumerate(sorted(set(want.values())))}
    assert got == {k: number[root] for k, root in want.items()}


def test_conflicts_are_refused(spark):
    tiles = grid.tile_grid(spark.createDataFrame([(0, 0), (20, 10)], "X long, Y long"), 10, 4)
    say = lambda sem: cloud(spark, [(0, 1, 9, 5, 0, 1, 1), (1, 2, 9, 5, 0, 1, sem)])
    assert ownership.pipeline(say(1), tiles, 4, refuse=True).count() == 1
    ground = cloud(spark, [(0, 1, 9, 5, 0, 0, 1), (1, 2, 9, 5, 0, 0, 2)])
    with pytest.raises(ValueError, match="conflict"):
        ownership.pipeline(ground, tiles, 4, refuse=True)


def test_barred_candidates_are_never_admitted(spark):
    claims = spark.createDataFrame([(0, i, 10 * k, 0, 0) for i, n in ((1, 4), (2, 3), (3, 2)) for k in range(10 * i, 10 * i + n)], "tile long, inst long, X long, Y long, Z long")
    bars = spark.createDataFrame([(0, 1, 0, 2), (0, 3, None, None)], "tile long, inst long, other long, other_inst long")
    assert [(r.inst, r.score) for r in reconcile.greedy_cover(claims, 1, bars).collect()] == [(1, 4)]


def test_colors_follow_the_rule(spark):
    rnd = random.Random(2)
    p = cloud(spark, [(0, i, rnd.randrange(500), rnd.randrange(500), 0, i, 0) for i in range(1, 40)])
    names = coloring.palette(6)
    labs = [coloring.lab(coloring.rgb(c)) for c in names]
    got = {r.inst: r.color - 1 for r in coloring.colors(p, names, k=4).collect()}
    near = {}
    for r in instances.nearest_centroids(p, 4).collect():
        near.setdefault(r.inst, []).append((r.distance, r.other))
    draws, seen = np.random.default_rng(0), {}
    for inst in sorted(near, key=lambda i: (sum(d for d, _ in near[i]) / 5, i)):
        used = {seen[o] for _, o in near[inst] if o in seen}
        far = lambda c: sum(np.linalg.norm(labs[c] - labs[u]) for u in used)  # noqa: B023, E731
        want = {int(draws.integers(6))} if not used else {c for c in set(range(6)) - used if abs(far(c) - max(map(far, set(range(6)) - used))) < 1e-9}
        assert got[inst] in want
        seen[inst] = got[inst]


def test_gates_raise(spark):
    p = cloud(spark, [(0, 1, 0, 0, 0, 5, 0)])
    with pytest.raises(Exception, match="no mapping"):
        instances.mapped(p, spark.createDataFrame([(4, 1)], "inst long, new long")).collect()
    with pytest.raises(Exception, match="no match"):
        product.require_covered(product.transfer(p, p.withColumn("X", F.lit(99).cast("long")), 1)).collect()
    a = spark.createDataFrame([(0, 1), (1, 2)], "k long, v long")
    with pytest.raises(Exception, match="versions differ"):
        product.positional_join(a, a.filter("k = 0"), ("k",), ("v",)).collect()


def test_octree_levels_are_bounded(spark):
    rnd = np.random.default_rng(1)
    rows = [(0, i, *map(int, rnd.integers(0, 64, 3)), 0, 0) for i in range(200)]
    got = octree.lod_levels(cloud(spark, rows), (0, 0, 0), 64, grid=2, leaf=20, depth=4)
    assert got.count() == 200 and got.select("pid").distinct().count() == 200
    assert got.filter("level = 0").count() <= 8


def test_clipping_keeps_area(spark):
    tri = mesh.triangles(*mesh.grid_mesh(spark, 4, 4, 50))
    cut = mesh.cut_to_extent(tri, 30, 170, 20, 110)
    assert abs(cut.agg(F.sum(F.abs(mesh.area2()))).first()[0] - 2 * 140 * 90) < 1e-6


def test_lab_round_trip():
    for c in ("#ff8800", "#123456", "#fff"):
        assert coloring.to_hex(coloring.from_lab(coloring.lab(coloring.rgb(c)))) == coloring.to_hex(coloring.rgb(c))


def test_components_of_long_chains_are_whole(spark):
    # a column of 100 tiles whose last one alone touches the column before it: the least node is far from the next least
    chain = [(99, 199), *((i, i - 1) for i in range(199, 100, -1)), (300, 300)]
    got = {r.node: r.component for r in reconcile._component_labels(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {99: 99, 300: 300} | {i: 99 for i in range(100, 200)}
    with pytest.raises(RuntimeError):
        components.components(spark.createDataFrame(chain, "u long, v long"), lambda x: x.persist(), rounds=2)
