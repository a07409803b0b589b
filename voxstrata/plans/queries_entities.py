"""Instances, ownership, reconciliation, recovery, consolidation and remapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstrata.operators import coloring, grid, instances, nearest, ownership, product, reconcile
from voxstrata.plans.catalogue import query
from voxstrata.plans.clouds import SQL, cloud, d2_sql, dense, dense_sql, layout, rect_sql

E, V, L = SQL["E"], SQL["V"], SQL["L"]
D = dense_sql("E")
R2 = 2_500  # squared reach across tiles on E
STATS = "count(*) AS n, " + ", ".join(f"min({a}) AS min_{a.lower()}, max({a}) AS max_{a.lower()}, CAST(sum({a}) AS BIGINT) AS sum_{a.lower()}" for a in "XYZ") + ", (max(X) - min(X)) * (max(Y) - min(Y)) * (max(Z) - min(Z)) AS volume"
HALF = "CAST(round_even(CAST(sum({}) AS DOUBLE) / count(*), 0) AS BIGINT)"


def rows_and_tiles(spark, d):
    p = cloud(spark, d, "E")
    t = layout(p, "E")
    return dense(p, t, "E"), t


@query("instance_stats", f"WITH {E} SELECT inst, {STATS} FROM E WHERE inst > 0 GROUP BY inst")
def instance_stats(spark, d):
    return instances.statistics(cloud(spark, d, "E"))


@query("instance_stats_lines", f"WITH {L} SELECT inst, {STATS} FROM L WHERE inst > 0 GROUP BY inst")
def instance_stats_lines(spark, d):
    return instances.statistics(cloud(spark, d, "L"))


@query("instance_anchor_centroid", f"WITH {D} SELECT tile, inst, {HALF.format('X')} AS ax, {HALF.format('Y')} AS ay FROM D WHERE inst > 0 GROUP BY tile, inst")
def instance_anchor_centroid(spark, d):
    return instances.anchors(rows_and_tiles(spark, d)[0], "centroid", ("tile", "inst"))


def _extreme(sign: str) -> str:
    return f"WITH {E} SELECT inst, arg_min(X, ({sign}Z, pid)) AS ax, arg_min(Y, ({sign}Z, pid)) AS ay FROM E WHERE inst > 0 GROUP BY inst"


@query("instance_anchor_highest", _extreme("-"))
def instance_anchor_highest(spark, d):
    return instances.anchors(cloud(spark, d, "E"), "highest")


@query("instance_anchor_lowest", _extreme(""))
def instance_anchor_lowest(spark, d):
    return instances.anchors(cloud(spark, d, "E"), "lowest")


def alias(spark, d):
    return cloud(spark, d, "E").filter("inst > 6").select("inst", (F.col("inst") - 5).alias("target")).distinct()


@query("instance_summary", f"WITH {E}, f AS (SELECT CASE WHEN inst > 6 THEN inst - 5 ELSE inst END AS id, inst FROM E WHERE inst > 0) SELECT id AS inst, count(*) AS n, coalesce(string_agg(DISTINCT CASE WHEN inst != id THEN CAST(inst AS VARCHAR) END, ','), '') AS reassigned_from FROM f GROUP BY id")
def instance_summary(spark, d):
    return instances.summary(cloud(spark, d, "E"), alias(spark, d))


@query("label_violations", "SELECT count(*) FILTER (v IS NULL) AS missing, count(*) FILTER (v < 0) AS negative, count(*) FILTER (v != floor(v)) AS fractional, count(*) FILTER (v > 4294967295) AS too_large, count(*) FILTER (v = 7) AS no_data, count(*) AS total FROM (SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -1 WHEN event_id % 17 = 0 THEN 2.5 WHEN event_id % 19 = 0 THEN 5e9 ELSE user_id % 50 END AS v FROM events)")
def label_violations(spark, d):
    e = F.col("pid")
    odd = F.when(e % 11 == 0, None).when(e % 13 == 0, -1.0).when(e % 17 == 0, 2.5).when(e % 19 == 0, 5e9).otherwise(F.col("inst").cast("double"))
    return instances.violations(cloud(spark, d, "V").withColumn("label", odd), "label", 7)


@query("reused_ids", f"WITH {V}, b AS (SELECT inst, file, min(X) AS lx, max(X) AS hx, min(Y) AS ly, max(Y) AS hy FROM V WHERE inst > 0 GROUP BY inst, file), g AS (SELECT inst, count(*) AS files, greatest(max(lx) - min(hx), 0) AS gx, greatest(max(ly) - min(hy), 0) AS gy FROM b GROUP BY inst) SELECT inst, files, gx * gx + gy * gy AS gap2, gx * gx + gy * gy > 4000 * 4000 AS reused FROM g")
def reused_ids(spark, d):
    return instances.reused(cloud(spark, d, "V"), 4000)


@query("reuse_check", f"WITH {V}, b AS (SELECT inst, file, min(Y) AS ly, max(Y) AS hy, min(X) AS lx, max(X) AS hx FROM V WHERE inst > 0 GROUP BY inst, file), g AS (SELECT inst, greatest(max(ly) - min(hy), 0) ** 2 + greatest(max(lx) - min(hx), 0) ** 2 > 16000000 AS r FROM b GROUP BY inst) SELECT count(*) AS instances, count(*) FILTER (r) AS reused, count(*) FILTER (r) > greatest(10, 0.05 * count(*)) AS failed FROM g")
def reuse_check(spark, d):
    return instances.reuse_check(cloud(spark, d, "V"), 4000)


@query("wide_instances", f"WITH {V} SELECT inst, count(*) AS n, min(X) AS min_x, max(X) AS max_x, min(Y) AS min_y, max(Y) AS max_y FROM V WHERE inst > 0 GROUP BY inst HAVING max(X) - min(X) > 30000 OR max(Y) - min(Y) > 30000")
def wide_instances(spark, d):
    return instances.wide(cloud(spark, d, "V"), 30_000)


@query("majority_semantic", f"WITH {V}, c AS (SELECT inst, sem, count(*) AS n FROM V WHERE inst > 0 GROUP BY inst, sem) SELECT inst, arg_min(sem, (-n, sem)) AS sem, max(n) AS votes FROM c GROUP BY inst")
def majority_semantic(spark, d):
    return instances.majority(cloud(spark, d, "V"))


@query("ids_per_file", f"WITH {V} SELECT DISTINCT file, inst FROM V WHERE inst > 0")
def ids_per_file(spark, d):
    return instances.ids_per_file(cloud(spark, d, "V"))


@query("ground_rows", f"WITH {E} SELECT pid, inst - 1 <= 0 AS viewer, inst - 1 = 0 AS ground FROM E")
def ground_rows(spark, d):
    v = F.col("inst") - 1
    return cloud(spark, d, "E").select("pid", instances.is_ground(v, viewer=True).alias("viewer"), instances.is_ground(v).alias("ground"))


OWNED = "(west IS NULL OR ax >= x0) AND (east IS NULL OR ax <= x1) AND (south IS NULL OR ay >= y0) AND (north IS NULL OR ay <= y1)"
HALF_OPEN = "(west IS NULL OR X >= x0) AND (east IS NULL OR X < x1) AND (south IS NULL OR Y >= y0) AND (north IS NULL OR Y < y1)"
FILTERED = f"""{D}, anc AS (SELECT tile, inst, {HALF.format('X')} AS ax, {HALF.format('Y')} AS ay FROM D WHERE inst > 0 GROUP BY tile, inst), w AS (SELECT tile, inst FROM anc JOIN N USING (tile) WHERE {OWNED}),
    CF AS (SELECT D.* FROM D JOIN w USING (tile, inst) UNION ALL SELECT D.* FROM D JOIN N USING (tile) WHERE D.inst = 0 AND {HALF_OPEN})"""


@query("core_filter", f"WITH {FILTERED} SELECT tile, pid, inst FROM CF")
def core_filter(spark, d):
    p, t = rows_and_tiles(spark, d)
    return ownership.core_filter(p, t, grid.neighbors(t)).select("tile", "pid", "inst")


@query("kept_rows", f"WITH {FILTERED} SELECT D.tile, D.pid FROM D ANTI JOIN CF ON CF.tile = D.tile AND CF.pid = D.pid")
def kept_rows(spark, d):
    p, t = rows_and_tiles(spark, d)
    return p.join(ownership.core_filter(p, t, grid.neighbors(t)).select("tile", "pid"), ["tile", "pid"], "left_anti").select("tile", "pid")


TREE = "SELECT * FROM D WHERE inst > 0"
BOX = "{p}.X BETWEEN O.ox0 AND O.ox1 AND {p}.Y BETWEEN O.oy0 AND O.oy1"
PAIRS = f"""{D}, P AS (SELECT q.tile, q.pid, b.tile AS other, any_value(q.inst) AS a, any_value(q.sem) AS qs, arg_min(b.inst, ({d2_sql('q', 'b')}, b.pid)) AS b, arg_min(b.sem, ({d2_sql('q', 'b')}, b.pid)) AS bs
    FROM ({TREE}) q JOIN ({TREE}) b ON b.tile < q.tile AND {d2_sql('q', 'b')} <= {R2} JOIN O ON O.later = q.tile AND O.earlier = b.tile WHERE {BOX.format(p='q')} AND {BOX.format(p='b')} GROUP BY q.tile, q.pid, b.tile),
    PC AS (SELECT tile, a, other, b, count(*) AS n, count(*) FILTER (qs = bs) AS agree FROM P GROUP BY tile, a, other, b)"""
SHAPES = "SH AS (SELECT D.tile, o.other, D.inst, count(*) AS n, CAST(sum(X) AS BIGINT) AS sx, CAST(sum(Y) AS BIGINT) AS sy, CAST(sum(Z) AS BIGINT) AS sz FROM D JOIN (SELECT later AS tile, earlier AS other, ox0, ox1, oy0, oy1 FROM O UNION ALL SELECT earlier, later, ox0, ox1, oy0, oy1 FROM O) o ON o.tile = D.tile AND X BETWEEN ox0 AND ox1 AND Y BETWEEN oy0 AND oy1 WHERE inst > 0 GROUP BY 1, 2, 3)"
BEST = "MB AS (SELECT * FROM PC p WHERE NOT EXISTS (SELECT 1 FROM PC x WHERE x.tile = p.tile AND x.a = p.a AND x.other = p.other AND x.b != p.b AND x.n >= p.n) AND NOT EXISTS (SELECT 1 FROM PC x WHERE x.other = p.other AND x.b = p.b AND x.tile = p.tile AND x.a != p.a AND x.n >= p.n))"


def _overlap(spark, d):
    p, t = rows_and_tiles(spark, d)
    return p, grid.overlaps(t)


@query("pair_counts", f"WITH {PAIRS} SELECT * FROM PC")
def pair_counts(spark, d):
    return reconcile.pair_counts(*_overlap(spark, d), R2)


@query("overlap_centroids", f"WITH {D}, {SHAPES} SELECT * FROM SH")
def overlap_centroids(spark, d):
    return reconcile.overlap_shapes(*_overlap(spark, d))


@query("mutual_best_pairs", f"WITH {PAIRS}, {BEST} SELECT * FROM MB")
def mutual_best_pairs(spark, d):
    return reconcile.mutual_best(reconcile.pair_counts(*_overlap(spark, d), R2))


EDGES = f"""{PAIRS}, {BEST}, {SHAPES}, SZ AS (SELECT tile, inst, count(*) AS s FROM D WHERE inst > 0 GROUP BY 1, 2),
    EG AS (SELECT m.*, round((l.sx / l.n - r.sx / r.n) ** 2 + (l.sy / l.n - r.sy / r.n) ** 2 + (l.sz / l.n - r.sz / r.n) ** 2, 3) AS centroid2 FROM MB m JOIN SZ x ON x.tile = m.tile AND x.inst = m.a JOIN SZ y ON y.tile = m.other AND y.inst = m.b
        LEFT JOIN SH l ON l.tile = m.tile AND l.other = m.other AND l.inst = m.a LEFT JOIN SH r ON r.tile = m.other AND r.other = m.tile AND r.inst = m.b WHERE m.n >= 0.2 * least(x.s, y.s) AND m.n >= 2 AND 2 * m.agree >= m.n)"""


def _edges(spark, d):
    return reconcile.match_edges(*_overlap(spark, d), R2, threshold=0.2, least=2, most_distance=5000)


@query("match_edges", f"WITH {EDGES} SELECT tile, a, other, b, n, agree, centroid2 FROM EG WHERE centroid2 <= 25000000")
def match_edges(spark, d):
    return _edges(spark, d)


@query("edge_order", f"WITH {EDGES} SELECT tile, a, other, b, n, row_number() OVER (ORDER BY CASE WHEN a % 2 = 1 AND b % 2 = 1 THEN 0 ELSE 1 END, CASE WHEN a % 2 = 1 AND b % 2 = 1 THEN 0 ELSE -n END, tile, a, other, b) AS place FROM EG WHERE centroid2 <= 25000000")
def edge_order(spark, d):
    return reconcile.ordered_edges(_edges(spark, d), (F.col("a") % 2 == 1) & (F.col("b") % 2 == 1)).select("tile", "a", "other", "b", "n", F.col("place").cast("long").alias("place"))


@query("reconciled_groups")
def reconciled_groups(spark, d):
    return reconcile.reconciled(*_overlap(spark, d), _edges(spark, d))


CLAIMS = f"{D}, CL AS (SELECT DISTINCT tile, inst, X, Y, Z FROM D q WHERE inst > 4 AND NOT EXISTS (SELECT 1 FROM D b WHERE b.inst BETWEEN 1 AND 2 AND {d2_sql('q', 'b')} <= {R2}))"


def _claims(spark, d):
    p, _ = rows_and_tiles(spark, d)
    return reconcile.claims(p.filter("inst > 4"), p.filter("inst IN (1, 2)"), R2), p


@query("claims", f"WITH {CLAIMS} SELECT * FROM CL")
def claims(spark, d):
    return _claims(spark, d)[0]


@query("claims_census", f"WITH {CLAIMS} SELECT tile, inst, count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT X, Y, Z FROM CL)) AS all_locations FROM CL GROUP BY tile, inst")
def claims_census(spark, d):
    return reconcile.claims_census(_claims(spark, d)[0])


@query("orphan_recovery")
def orphan_recovery(spark, d):
    return reconcile.greedy_cover(_claims(spark, d)[0], R2)


@query("greedy_argmax", f"WITH {CLAIMS} SELECT tile, inst, count(*) AS score FROM CL GROUP BY tile, inst ORDER BY score DESC, tile, inst LIMIT 1")
def greedy_argmax(spark, d):
    counts = _claims(spark, d)[0].groupBy("tile", "inst").agg(F.count("*").alias("score"))
    return counts.orderBy(F.desc("score"), "tile", "inst").limit(1)


@query("recovered_support")
def recovered_support(spark, d):
    c, p = _claims(spark, d)
    return reconcile.supported(c, reconcile.greedy_cover(c, R2), p.filter("inst > 4"), R2)


@query("rct_conflict_edges", f"WITH {D} SELECT DISTINCT q.tile, q.inst, CAST(-1 AS BIGINT) AS other, CAST(-1 AS BIGINT) AS other_inst FROM D q JOIN D b ON q.inst > 6 AND b.inst = 1 AND {d2_sql('q', 'b')} <= {R2} UNION SELECT q.tile, q.inst, b.tile, b.inst FROM D q JOIN D b ON q.inst > 6 AND b.inst > 6 AND (q.tile, q.inst) < (b.tile, b.inst) AND {d2_sql('q', 'b')} <= {R2}")
def rct_conflict_edges(spark, d):
    p, _ = rows_and_tiles(spark, d)
    return reconcile.conflict_edges(p.filter("inst > 6"), p.filter("inst = 1"), R2).fillna(-1)


@query("rct_recovery_gate")
def rct_recovery_gate(spark, d):
    c, p = _claims(spark, d)
    edges = reconcile.conflict_edges(p.filter("inst > 4"), p.filter("inst = 1"), 25)
    return reconcile.greedy_cover(c, R2, edges)


def before(p: str, one: str, other: str) -> str:
    return f"({rect_sql(p, one)}, {one}.tile) < ({rect_sql(p, other)}, {other}.tile)"


LOST = f"SELECT DISTINCT q.tile, q.pid FROM ({TREE}) q JOIN ({TREE}) b ON q.tile != b.tile AND {d2_sql('q', 'b')} <= {R2} JOIN T tq ON tq.tile = q.tile JOIN T tb ON tb.tile = b.tile WHERE {before('q', 'tb', 'tq')} AND {before('b', 'tb', 'tq')}"


@query("shared_point_owner", f"WITH {D}, S AS ({LOST}) SELECT tile, pid FROM D ANTI JOIN S USING (tile, pid)")
def shared_point_owner(spark, d):
    p, t = rows_and_tiles(spark, d)
    return ownership.shared_points(p, t, R2).select("tile", "pid")


@query("tree_over_background", f"WITH {D} SELECT tile, pid FROM D q WHERE inst > 0 OR NOT EXISTS (SELECT 1 FROM D b WHERE b.inst > 0 AND b.tile != q.tile AND {d2_sql('q', 'b')} <= {R2})")
def tree_over_background(spark, d):
    return ownership.tree_over_background(rows_and_tiles(spark, d)[0], R2).select("tile", "pid")


@query("label_conflicts", f"WITH {D} SELECT q.tile, q.pid, b.tile AS other, b.pid AS other_pid, CAST({d2_sql('q', 'b')} AS BIGINT) AS d2 FROM D q JOIN D b ON b.tile < q.tile AND (b.inst != q.inst OR b.sem != q.sem) AND {d2_sql('q', 'b')} <= {R2} JOIN T tq ON tq.tile = q.tile JOIN T tb ON tb.tile = b.tile WHERE NOT (q.inst = 0 AND b.inst = 0 AND q.sem = 0 AND b.sem = 0) AND NOT ({before('q', 'tq', 'tb')} AND {before('b', 'tb', 'tq')})")
def label_conflicts(spark, d):
    p, t = rows_and_tiles(spark, d)
    return ownership.conflicts(p, t, R2)


TWO = "(SELECT tile, pid, X, Y, Z, inst % 2 AS inst, sem FROM D WHERE tile IN (5, 6))"


@query("dedup_two_tiles", f"WITH {D}, W AS {TWO}, B AS (SELECT q.pid, any_value(q.inst) AS qi, any_value(q.sem) AS qs, arg_min(b.inst, ({d2_sql('q', 'b')}, b.pid)) AS bi, arg_min(b.sem, ({d2_sql('q', 'b')}, b.pid)) AS bs FROM W q JOIN W b ON q.tile = 6 AND b.tile = 5 AND {d2_sql('q', 'b')} <= {R2} GROUP BY q.pid) SELECT tile, pid FROM W WHERE NOT (tile = 6 AND pid IN (SELECT pid FROM B WHERE qi = bi AND qs = bs))")
def dedup_two_tiles(spark, d):
    p, t = rows_and_tiles(spark, d)
    two = p.filter("tile IN (5, 6)").withColumn("inst", F.col("inst") % 2)
    return ownership.deduplicate(two, spark.createDataFrame([(6, 5)], "later long, earlier long"), R2).select("tile", "pid")


@query("dedup")
def dedup(spark, d):
    p, t = rows_and_tiles(spark, d)
    return ownership.deduplicate(p.withColumn("inst", F.col("inst") % 2), grid.overlaps(t), R2).select("tile", "pid")


@query("core_dedup_pipeline")
def core_dedup_pipeline(spark, d):
    p, t = rows_and_tiles(spark, d)
    return ownership.pipeline(p, t, R2).select("tile", "pid", "inst", "sem")


OWNED_CTE = f"{D}, GG AS (SELECT tile, pid, X, Y, Z, CASE WHEN inst = 0 THEN 0 ELSE inst END AS inst, sem FROM (SELECT tile, A.* EXCLUDE (tile) FROM A))"
PLAN = f"""{OWNED_CTE}, Q AS (SELECT inst, tile, count(*) AS n, sum(X) AS sx, sum(Y) AS sy FROM GG WHERE inst > 0 GROUP BY inst, tile), S AS (SELECT inst, sum(n) AS n, sum(sx) AS sx, sum(sy) AS sy, count(*) AS parts FROM Q GROUP BY inst HAVING count(*) > 1),
    PL AS (SELECT Q.inst, coalesce(min(Q.tile) FILTER (S.sx BETWEEN x0 * S.n AND x1 * S.n AND S.sy BETWEEN y0 * S.n AND y1 * S.n), arg_min(Q.tile, (-Q.n, Q.tile))) AS owner, any_value(S.parts) AS parts FROM Q JOIN S USING (inst) JOIN T USING (tile) GROUP BY Q.inst)"""


def _global(spark, d):
    p = cloud(spark, d, "E")
    t = layout(p, "E")
    return grid.assign_buffered(p.select("pid", "X", "Y", "Z", "inst", "sem"), t, 200, 40), t


@query("split_instances", f"WITH {OWNED_CTE} SELECT inst, count(DISTINCT tile) AS tiles FROM GG WHERE inst > 0 GROUP BY inst HAVING count(DISTINCT tile) > 1")
def split_instances(spark, d):
    return instances.split_instances(_global(spark, d)[0])


@query("owner_plan", f"WITH {PLAN} SELECT * FROM PL")
def owner_plan(spark, d):
    return instances.owner_plan(*_global(spark, d))


@query("consolidated", f"WITH {PLAN} SELECT coalesce(PL.owner, GG.tile) AS tile, GG.tile AS from_tile, pid, GG.inst FROM GG LEFT JOIN PL USING (inst)")
def consolidated(spark, d):
    p, t = _global(spark, d)
    return instances.consolidate(p, instances.owner_plan(p, t)).select("tile", "from_tile", "pid", "inst")


@query("moved_points", f"WITH {PLAN} SELECT PL.owner AS tile, count(*) AS moved FROM GG JOIN PL USING (inst) WHERE GG.tile != PL.owner GROUP BY 1")
def moved_points(spark, d):
    p, t = _global(spark, d)
    return instances.moved(instances.consolidate(p, instances.owner_plan(p, t)))


@query("verify_distinct", f"WITH {PLAN} SELECT GG.inst, CAST(1 AS BIGINT) AS tiles FROM GG GROUP BY GG.inst HAVING FALSE")
def verify_distinct(spark, d):
    p, t = _global(spark, d)
    return instances.split_instances(instances.consolidate(p, instances.owner_plan(p, t)))


@query("small_instances", f"WITH {L} SELECT inst, {STATS}, count(*) < 600 AND (max(X) - min(X)) * (max(Y) - min(Y)) * (max(Z) - min(Z)) < 1000000 AS small FROM L WHERE inst > 0 GROUP BY inst")
def small_instances(spark, d):
    return instances.small(cloud(spark, d, "L"), 600, 1_000_000)


@query("small_reassign", f"WITH {E}, s AS (SELECT inst, count(*) AS n, sum(X) / count(*) AS cx, sum(Y) / count(*) AS cy, (max(X) - min(X)) * (max(Y) - min(Y)) * (max(Z) - min(Z)) AS v FROM E WHERE inst > 0 GROUP BY inst), m AS (SELECT a.inst, arg_min(b.inst, ((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2, b.inst)) AS target, min((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2) AS d FROM s a, s b WHERE a.n < (SELECT median(n) FROM s) AND b.n >= (SELECT median(n) FROM s) GROUP BY a.inst) SELECT inst, target FROM m WHERE d <= 2500")
def small_reassign(spark, d):
    p = cloud(spark, d, "E")
    median = instances.statistics(p).agg(F.median("n")).first()[0]
    return instances.small_plan(p, median, 1 << 60, 50)


def _model(spark, d):
    p = cloud(spark, d, "E")
    return p.filter("pid % 3 = 0").select("pid", "X", "Y", "Z", "inst", "sem"), p


LABEL = f"SELECT q.pid, arg_min(b.inst, ({d2_sql('q', 'b')}, b.pid)) AS label, arg_min(b.sem, ({d2_sql('q', 'b')}, b.pid)) AS label_sem, CAST(min({d2_sql('q', 'b')}) AS BIGINT) AS d2 FROM E q JOIN E b ON b.pid % 3 = 0 AND {d2_sql('q', 'b')} <= {{r}} GROUP BY q.pid"


@query("transfer_labels", f"WITH {E} SELECT E.pid, m.label, m.label_sem, m.d2 FROM E LEFT JOIN ({LABEL.format(r=4_000_000)}) m USING (pid)")
def transfer_labels(spark, d):
    m, p = _model(spark, d)
    return product.require_covered(product.transfer(p, m, 4_000_000)).select("pid", "label", "label_sem", "d2")


@query("remap_originals", f"WITH {E} SELECT E.file, E.pid, coalesce(m.label, -1) AS m1, coalesce(n.label, 0) AS m2 FROM E LEFT JOIN ({LABEL.format(r=10_000)}) m USING (pid) LEFT JOIN ({LABEL.format(r=2_500)}) n USING (pid)")
def remap_originals(spark, d):
    m, p = _model(spark, d)
    return product.remap(p, {"m1": (m, 10_000, False), "m2": (m, 2_500, True)}).select("file", "pid", F.coalesce("m1", F.lit(-1).cast("long")).alias("m1"), "m2")


@query("compact_ids", f"WITH {V}, m AS (SELECT inst, dense_rank() OVER (ORDER BY inst) AS new FROM (SELECT DISTINCT inst FROM V WHERE inst > 0 AND inst % 3 != 1)) SELECT pid, coalesce(new, 0) AS new FROM V LEFT JOIN m USING (inst) WHERE inst % 3 != 1")
def compact_ids(spark, d):
    p = cloud(spark, d, "V").filter("inst % 3 != 1")
    return instances.mapped(p, instances.compact(p)).select("pid", "new")


@query("alias_compact", f"WITH {E}, m AS (SELECT inst, dense_rank() OVER (ORDER BY CASE WHEN inst > 6 THEN inst - 5 ELSE inst END) AS new FROM (SELECT DISTINCT inst FROM E WHERE inst > 0)) SELECT inst, new FROM m")
def alias_compact(spark, d):
    return instances.compact(cloud(spark, d, "E"), alias(spark, d))


@query("knn_centroids", f"WITH {L}, s AS (SELECT inst, sum(X) / count(*) AS x, sum(Y) / count(*) AS y, sum(Z) / count(*) AS z FROM L WHERE inst > 0 GROUP BY inst), n AS (SELECT a.inst, b.inst AS other, (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 AS d FROM s a JOIN s b ON a.inst != b.inst) SELECT inst, other, CAST(rank AS INTEGER) AS rank, round(sqrt(d), 6) AS distance FROM (SELECT *, row_number() OVER (PARTITION BY inst ORDER BY d, other) AS rank FROM n) WHERE rank <= 10")
def knn_centroids(spark, d):
    near = instances.nearest_centroids(cloud(spark, d, "L"), 10)
    return near.withColumn("distance", F.round("distance", 6))


@query("instance_colors")
def instance_colors(spark, d):
    return coloring.colors(cloud(spark, d, "L"), coloring.palette(12))


@query("near_pairs", f"WITH {E} SELECT q.pid, b.pid AS other, CAST({d2_sql('q', 'b')} AS BIGINT) AS d2 FROM E q JOIN E b ON q.pid < b.pid AND {d2_sql('q', 'b')} <= 6400")
def near_pairs(spark, d):
    p = cloud(spark, d, "E").select("pid", "X", "Y", "Z")
    return nearest.pairs(p, p, 6400, where=F.col("q_pid") < F.col("b_pid")).select(F.col("q_pid").alias("pid"), F.col("b_pid").alias("other"), "d2")
