"""Products, tables, meshes, octrees, streaming forms and text helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstrata.functions import lattice, names
from voxstrata.operators import mesh, octree, product
from voxstrata.plans.catalogue import query
from voxstrata.plans.clouds import SQL, cloud, table
from voxstrata.streaming import windows

E, V, L = SQL["E"], SQL["V"], SQL["L"]


@query("positional_join", "SELECT conv_id, turn, role, length(text) AS n_chars FROM conversations")
def positional_join(spark, d):
    c = table(spark, d, "conversations").dropDuplicates(["conv_id", "turn"])
    return product.positional_join(c.select("conv_id", "turn", "role"), c.select("conv_id", "turn", "role", F.length("text").cast("long").alias("n_chars")), ("conv_id", "turn"), ("role",))


@query("multiset_diff", f"WITH {V}, u AS (SELECT inst, sem, 1 AS s FROM V WHERE file != 1 UNION ALL SELECT inst, sem, -1 FROM V WHERE file != 2) SELECT inst, sem, CAST(sum(s) AS BIGINT) AS surplus FROM u GROUP BY inst, sem HAVING sum(s) != 0")
def multiset_diff(spark, d):
    p = cloud(spark, d, "V").select("file", "inst", "sem")
    return product.multiset_diff(p.filter("file != 1").drop("file"), p.filter("file != 2").drop("file"))


@query("full_merge_index", f"WITH {V} SELECT pid, file, row_number() OVER (ORDER BY file, pid) - 1 AS record FROM V")
def full_merge_index(spark, d):
    return product.record_index(cloud(spark, d, "V").select("pid", "file"))


@query("union_common_schema", f"WITH {E}, {V} SELECT pid, X, Y, Z, inst, CAST(0 AS BIGINT) AS gps FROM E UNION ALL SELECT pid, X, Y, Z, inst, gps FROM V")
def union_common_schema(spark, d):
    return product.union_common([cloud(spark, d, "E").select("pid", "X", "Y", "Z", "inst"), cloud(spark, d, "V").select("pid", "X", "Y", "Z", "inst", "gps")])


@query("common_columns", f"WITH {E}, {V} SELECT pid, file, X, Y, Z, inst, sem FROM E UNION ALL SELECT pid, file, X, Y, Z, inst, sem FROM V")
def common_columns(spark, d):
    a, b = cloud(spark, d, "E"), cloud(spark, d, "V")
    shared = product.common_columns(a, b)
    return a.select(*shared).unionByName(b.select(*shared))


@query("concat_tiles", f"WITH {V} SELECT file, count(*) AS n FROM V GROUP BY file")
def concat_tiles(spark, d):
    p = cloud(spark, d, "V")
    return product.union_common([p.filter(F.col("file") == i) for i in range(3)]).groupBy("file").agg(F.count("*").alias("n"))


@query("lossless_promotion", f"WITH {V} SELECT count(*) AS total, count(*) FILTER (gps NOT BETWEEN -2147483648 AND 2147483647) AS lost FROM V")
def lossless_promotion(spark, d):
    return product.lossless(cloud(spark, d, "V"), "gps", "int")


@query("entities_once", f"WITH {V} SELECT pid, file, sem FROM V QUALIFY file = min(file) OVER (PARTITION BY sem, inst)")
def entities_once(spark, d):
    p = cloud(spark, d, "V").withColumn("entity", F.struct("sem", "inst"))
    return product.entities_once(p, "entity", "file").select("pid", "file", "sem")


@query("key_symdiff", f"WITH {V}, a AS (SELECT DISTINCT inst FROM V WHERE file = 0), b AS (SELECT DISTINCT inst FROM V WHERE file = 1) SELECT inst, 'left' AS side FROM a WHERE inst NOT IN (FROM b) UNION ALL SELECT inst, 'right' FROM b WHERE inst NOT IN (FROM a)")
def key_symdiff(spark, d):
    p = cloud(spark, d, "V")
    return product.key_symdiff(p.filter("file = 0"), p.filter("file = 1"), ("inst",))


@query("id_set_equality", f"WITH {V}, a AS (SELECT DISTINCT pid FROM V WHERE pid % 7 != 0), b AS (SELECT DISTINCT pid FROM V WHERE pid % 5 != 0) SELECT (SELECT count(*) FROM a WHERE pid NOT IN (FROM b)) AS only_left, (SELECT count(*) FROM b WHERE pid NOT IN (FROM a)) AS only_right, FALSE AS equal")
def id_set_equality(spark, d):
    p = cloud(spark, d, "V")
    return product.id_sets_equal(p.filter("pid % 7 != 0"), p.filter("pid % 5 != 0"), "pid")


@query("set_ops", f"WITH {V} SELECT 'intersect' AS op, inst FROM ((SELECT inst FROM V WHERE sem = 0) INTERSECT (SELECT inst FROM V WHERE file = 1)) UNION ALL SELECT 'except', inst FROM ((SELECT inst FROM V WHERE sem = 0) EXCEPT (SELECT inst FROM V WHERE file = 1))")
def set_ops(spark, d):
    p = cloud(spark, d, "V")
    a, b = p.filter("sem = 0").select("inst"), p.filter("file = 1").select("inst")
    return a.intersect(b).select(F.lit("intersect").alias("op"), "inst").unionByName(a.exceptAll(b).distinct().join(b, "inst", "left_anti").select(F.lit("except").alias("op"), "inst"))


@query("run_starts", f"WITH {V}, s AS (SELECT pid, file, CAST(CASE WHEN lag(sem) OVER (PARTITION BY file ORDER BY pid) = sem THEN 0 ELSE 1 END AS INTEGER) AS starts FROM V) SELECT pid, starts, CAST(sum(starts) OVER (PARTITION BY file ORDER BY pid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run FROM s")
def run_starts(spark, d):
    return product.run_starts(cloud(spark, d, "V"), "file", "pid", "sem").select("pid", "starts", "run")


@query("top_examples", f"WITH {V} SELECT pid, X FROM V ORDER BY X DESC, pid LIMIT 5")
def top_examples(spark, d):
    return product.top_examples(cloud(spark, d, "V").select("pid", "X"), [F.desc("X"), F.col("pid")], 5)


@query("stable_tile_order", "SELECT s_name AS name, row_number() OVER (ORDER BY lower(s_name), s_name) - 1 AS tile FROM supplier")
def stable_tile_order(spark, d):
    return names.stable_order(table(spark, d, "supplier").select(F.col("s_name").alias("name")))


@query("sink_order", f"WITH {V} SELECT pid, gps FROM V")
def sink_order(spark, d):
    return product.sink_order(cloud(spark, d, "V").select("pid", "gps"), ["gps", "pid"], 4)


@query("vector_components", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS a0, round(CAST(embedding[2] AS DOUBLE), 6) AS a1, len(embedding) AS n FROM embeddings")
def vector_components(spark, d):
    t = table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 3).alias("v"), F.size("embedding").cast("long").alias("n"))
    back = product.rebuilt_vector(product.vector_components(t, "v", 3), "v", 3)
    return back.select("vec_id", *(F.round(F.get("v", F.lit(i)).cast("double"), 6).alias(f"a{i}") for i in range(2)), "n")


@query("rct_encode", f"WITH {V} SELECT pid, CASE WHEN inst = 0 THEN 0 ELSE sem * 100000 + inst END AS code FROM V")
def rct_encode(spark, d):
    return cloud(spark, d, "V").select("pid", lattice.encode_rct("sem", "inst").alias("code"))


@query("rct_decode", f"WITH {V} SELECT pid, CASE WHEN inst = 0 THEN 0 ELSE sem END AS tile, inst AS local FROM V")
def rct_decode(spark, d):
    tile, local = lattice.decode_rct(lattice.encode_rct("sem", "inst"))
    return cloud(spark, d, "V").select("pid", tile.alias("tile"), local.alias("local"))


@query("tree_table_filter", "SELECT s_suppkey AS id, row_number() OVER (ORDER BY s_suppkey) AS new, round(s_acctbal, 2) AS value FROM supplier WHERE s_suppkey % 2 = 0")
def tree_table_filter(spark, d):
    t = table(spark, d, "supplier")
    kept = t.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("inst"))
    from pyspark.sql import Window

    ids = kept.distinct().select("inst", F.dense_rank().over(Window.orderBy("inst")).cast("long").alias("new"))
    return t.join(F.broadcast(ids), t["s_suppkey"] == ids["inst"]).select(F.col("s_suppkey").alias("id"), "new", F.round("s_acctbal", 2).alias("value"))


MESH = """v AS (SELECT range AS vid, range % 13 * 50 AS x, range // 13 * 50 AS y, 100 + range % 13 * 5 AS z FROM range(117)),
    f AS (SELECT q.range * 2 + k AS fid, q.range // 12 * 13 + q.range % 12 AS v0, CASE k WHEN 0 THEN q.range // 12 * 13 + q.range % 12 + 1 ELSE q.range // 12 * 13 + q.range % 12 + 14 END AS v1,
        CASE k WHEN 0 THEN q.range // 12 * 13 + q.range % 12 + 14 ELSE q.range // 12 * 13 + q.range % 12 + 13 END AS v2 FROM range(96) q, (VALUES (0), (1)) AS k(k)),
    t AS (SELECT f.fid, a.x AS x0, a.y AS y0, a.z AS z0, b.x AS x1, b.y AS y1, b.z AS z1, c.x AS x2, c.y AS y2, c.z AS z2 FROM f JOIN v a ON a.vid = v0 JOIN v b ON b.vid = v1 JOIN v c ON c.vid = v2)"""


def _mesh(spark):
    return mesh.grid_mesh(spark, 12, 8, 50)


@query("triangle_vertices", f"WITH {MESH} SELECT * FROM t")
def triangle_vertices(spark, d):
    return mesh.triangles(*_mesh(spark)).drop("mesh")


@query("triangle_area", f"WITH {MESH} SELECT fid, (x1 - x0) * (y2 - y0) - (x2 - x0) * (y1 - y0) AS area2 FROM t")
def triangle_area(spark, d):
    return mesh.triangles(*_mesh(spark)).select("fid", mesh.area2().alias("area2"))


@query("triangle_extent_class", f"WITH {MESH} SELECT fid, CASE WHEN least(x0, x1, x2) >= 120 AND greatest(x0, x1, x2) <= 430 AND least(y0, y1, y2) >= 70 AND greatest(y0, y1, y2) <= 310 THEN 'inside' WHEN greatest(x0, x1, x2) < 120 OR least(x0, x1, x2) > 430 OR greatest(y0, y1, y2) < 70 OR least(y0, y1, y2) > 310 THEN 'outside' ELSE 'crossing' END AS place FROM t")
def triangle_extent_class(spark, d):
    return mesh.extent_class(mesh.triangles(*_mesh(spark)), 120, 430, 70, 310).select("fid", "place")


@query("mesh_core_filter", f"WITH {MESH} SELECT fid FROM t WHERE (x0 + x1 + x2) / 3.0 >= 150 AND (x0 + x1 + x2) / 3.0 < 400 AND (y0 + y1 + y2) / 3.0 >= 50 AND (y0 + y1 + y2) / 3.0 < 300")
def mesh_core_filter(spark, d):
    return mesh.core_faces(mesh.triangles(*_mesh(spark)), 150, 400, 50, 300).select("fid")


def _two(spark):
    (va, fa), (vb, fb) = mesh.grid_mesh(spark, 4, 4, 50, 0), mesh.grid_mesh(spark, 4, 4, 50, 1)
    return va.unionByName(vb.withColumn("x", F.col("x") + 200).withColumn("z", F.expr("100 + x DIV 10"))), fa.unionByName(fb)


@query("mesh_weld", "SELECT count(*) AS vertices, count(DISTINCT x || ':' || y) AS places, CAST(min(range) AS BIGINT) AS first, count(*) - 1 AS last FROM (SELECT DISTINCT (m * 4 + i.range) * 50 AS x, j.range * 50 AS y, 0 AS range FROM (VALUES (0), (1)) AS m(m), range(5) i, range(5) j)")
def mesh_weld(spark, d):
    v, _ = mesh.weld(*_two(spark))
    return v.agg(F.count("*").alias("vertices"), F.countDistinct(F.concat_ws(":", "x", "y")).alias("places"), F.min("vid").alias("first"), F.max("vid").alias("last"))


@query("mesh_boundary_edges", f"WITH {MESH}, e AS (SELECT least(v0, v1) AS a, greatest(v0, v1) AS b FROM f UNION ALL SELECT least(v1, v2), greatest(v1, v2) FROM f UNION ALL SELECT least(v2, v0), greatest(v2, v0) FROM f) SELECT a, b FROM e GROUP BY a, b HAVING count(*) = 1")
def mesh_boundary_edges(spark, d):
    return mesh.boundary_edges(_mesh(spark)[1]).select("a", "b")


@query("vertex_remap", f"WITH {MESH}, u AS (SELECT v0 AS vid FROM f WHERE fid % 5 = 0 UNION SELECT v1 FROM f WHERE fid % 5 = 0 UNION SELECT v2 FROM f WHERE fid % 5 = 0) SELECT vid, row_number() OVER (ORDER BY vid) - 1 AS new FROM u")
def vertex_remap(spark, d):
    v, f = _mesh(spark)
    return mesh.used_vertices(v, f.filter("fid % 5 = 0")).select("vid", "new")


@query("near_core_lines", f"WITH {MESH} SELECT vid FROM v WHERE abs(x - 200) <= 20 AND y BETWEEN -20 AND 270 OR abs(y - 130) <= 20 AND x BETWEEN 80 AND 420")
def near_core_lines(spark, d):
    lines = spark.createDataFrame([("x", 200, 0, 250), ("y", 130, 100, 400)], "axis string, at long, lo long, hi long")
    return mesh.near_lines(_mesh(spark)[0], lines, 20).select("vid")


@query("terrain_grid", "SELECT r.range AS row, c.range AS col, CAST(100 + (c.range * 40 + 20) / 10.0 AS DOUBLE) AS height FROM range(10) r, range(15) c")
def terrain_grid(spark, d):
    tri = mesh.triangles(*_mesh(spark))
    return mesh.terrain_grid(tri, 0, 0, 40, 15, 10).select("row", "col", F.round("height", 6).alias("height"))


@query("clip_polygon")
def clip_polygon(spark, d):
    return mesh.cut_to_extent(mesh.triangles(*_mesh(spark)), 120, 430, 70, 310)


@query("original_terrain", "SELECT CAST(310 * 240 * 2 AS DOUBLE) AS area2")
def original_terrain(spark, d):
    cut = mesh.cut_to_extent(mesh.triangles(*_mesh(spark)), 120, 430, 70, 310)
    return cut.agg(F.round(F.sum(F.abs(mesh.area2())), 6).alias("area2"))


@query("mesh_ranges", f"WITH {MESH} SELECT fid // 24 AS tree, min(fid) AS first, max(fid) AS last, count(*) AS n, TRUE AS contiguous FROM f GROUP BY 1")
def mesh_ranges(spark, d):
    return mesh.mesh_ranges(_mesh(spark)[1].withColumn("tree", F.expr("fid DIV 24"))).drop("mesh")


@query("splitmix_rank")
def splitmix_rank(spark, d):
    return cloud(spark, d, "V").select("pid", lattice.splitmix64("pid").alias("hash"))


LOD = f"WITH {E}, z AS (SELECT pid, X + 512 AS x, Y + 512 AS y, Z + 512 AS z FROM E)"


@query("lod_level0", f"{LOD} SELECT min(pid) AS pid FROM z GROUP BY x * 4 // 1024, y * 4 // 1024, z * 4 // 1024")
def lod_level0(spark, d):
    return octree.lod_levels(cloud(spark, d, "E").select("pid", "X", "Y", "Z"), (-512, -512, -512), 1024, grid=4, leaf=50, depth=6).filter("level = 0").select("pid")


def _lod(spark, d):
    return octree.lod_levels(cloud(spark, d, "E").select("pid", "X", "Y", "Z"), (-512, -512, -512), 1024, grid=4, leaf=50, depth=6)


@query("lod_octree")
def lod_octree(spark, d):
    return _lod(spark, d).select("pid", "level", "nx", "ny", "nz")


@query("level_counts")
def level_counts(spark, d):
    return octree.level_counts(_lod(spark, d))


def _cylinders(spark, d):
    v = cloud(spark, d, "V")
    return v.select(F.col("pid").alias("id"), (F.col("sem") + 1).cast("double").alias("radius"), (F.col("X") * (F.col("sem") + 1)).alias("importance"), F.col("X").alias("mx"), F.col("Y").alias("my"), F.col("Z").alias("mz"))


@query("qsm_root_level", f"WITH {V} SELECT pid AS id, 'r' AS node FROM V ORDER BY X * (sem + 1) DESC, pid LIMIT 200")
def qsm_root_level(spark, d):
    return octree.importance_levels(_cylinders(spark, d), 65_536, 200, 4).filter("level = 0").select("id", "node")


@query("qsm_importance_levels")
def qsm_importance_levels(spark, d):
    return octree.node_statistics(octree.importance_levels(_cylinders(spark, d), 65_536, 200, 4))


@query("qsm_tree_volume", f"WITH {V}, p AS (SELECT inst, pid, X, Y, Z, row_number() OVER (PARTITION BY inst ORDER BY pid) - 1 AS i FROM V WHERE inst > 0), j AS (SELECT a.inst, 3.141592653589793::DOUBLE * 4 * sqrt((a.X - b.X) ** 2 + (a.Y - b.Y) ** 2 + (a.Z - b.Z) ** 2) AS v FROM p a JOIN p b ON a.inst = b.inst AND b.i = a.i - 1) SELECT inst AS id, CAST(count(*) AS INTEGER) AS cylinders, round(sum(v) / 1000, 3) AS volume FROM j GROUP BY inst")
def qsm_tree_volume(spark, d):
    v = cloud(spark, d, "V").filter("inst > 0").groupBy(F.col("inst").alias("id")).agg(F.sort_array(F.collect_list(F.struct("pid", "X", "Y", "Z"))).alias("s"))
    made = v.select("id", F.transform("s", lambda x, i: F.struct(x["X"].cast("double").alias("x"), x["Y"].cast("double").alias("y"), x["Z"].cast("double").alias("z"), F.lit(2.0).alias("radius"), (i - 1).alias("parent_id"))).alias("segments"))
    return octree.tree_volume(made).withColumn("volume", F.round(F.col("volume") / 1000, 3))


@query("oct_encode", f"WITH {E}, u AS (SELECT pid, X / (abs(X) + abs(Y) + abs(Z) + 0.0::DOUBLE) AS u, Y / (abs(X) + abs(Y) + abs(Z) + 0.0::DOUBLE) AS v, Z FROM E WHERE abs(X) + abs(Y) + abs(Z) > 0) SELECT pid, round(CASE WHEN Z >= 0 THEN u ELSE (1 - abs(v)) * CASE WHEN u >= 0 THEN 1 ELSE -1 END END, 6) AS ou, round(CASE WHEN Z >= 0 THEN v ELSE (1 - abs(u)) * CASE WHEN v >= 0 THEN 1 ELSE -1 END END, 6) AS ov FROM u")
def oct_encode(spark, d):
    u, v = lattice.octahedral(*(F.col(a).cast("double") for a in "XYZ"))
    return cloud(spark, d, "E").filter("abs(X) + abs(Y) + abs(Z) > 0").select("pid", F.round(u, 6).alias("ou"), F.round(v, 6).alias("ov"))


@query("quantize_u16", f"WITH {E} SELECT pid, CAST(least(greatest(round_even((X + 300) / 600.0::DOUBLE * 65535, 0), 0), 65535) AS INTEGER) AS q FROM E")
def quantize_u16(spark, d):
    return cloud(spark, d, "E").select("pid", lattice.quantized_u16(F.col("X").cast("double"), F.lit(-300.0), F.lit(600.0)).alias("q"))


@query("file_stem", "SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') AS stem FROM pages")
def file_stem(spark, d):
    return table(spark, d, "pages").select("page_id", names.stem("url").alias("stem"))


@query("tile_label", "SELECT s_suppkey AS id, printf('c%02d_r%02d', CAST(s_suppkey // 7 AS INTEGER), CAST(s_suppkey % 7 AS INTEGER)) AS label FROM supplier")
def tile_label(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), names.tile_label(F.expr("s_suppkey DIV 7"), F.col("s_suppkey") % 7).alias("label"))


@query("tile_key_regex", "SELECT s_suppkey AS id, 'c' || lpad(CAST(s_suppkey // 7 AS VARCHAR), 2, '0') || '_r' || lpad(CAST(s_suppkey % 7 AS VARCHAR), 2, '0') AS key FROM supplier")
def tile_key_regex(spark, d):
    two = lambda c: F.lpad(F.expr(c).cast("string"), 2, "0")  # noqa: E731  # these names have fields of two places
    name = F.concat(F.lit("Model_X_C"), two("s_suppkey DIV 7"), F.lit("_R"), two("s_suppkey % 7"), F.lit("_trees.TXT"))
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), names.tile_key(name).alias("key"))


@query("input_listing", "SELECT s_suppkey AS id, 'cloud' || s_suppkey || CASE WHEN s_suppkey % 3 = 0 THEN '.copc.laz' ELSE '.laz' END AS name FROM supplier")
def input_listing(spark, d):
    s = table(spark, d, "supplier")
    raw = s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("cloud"), F.col("s_suppkey"), F.lit(".laz")).alias("name"))
    twin = s.filter("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("cloud"), F.col("s_suppkey"), F.lit(".copc.laz")).alias("name"))
    return names.preferred_inputs(raw.unionByName(twin))


@query("tile_pairing", "SELECT a.s_suppkey AS source, b.s_suppkey AS target FROM supplier a JOIN supplier b ON a.s_suppkey % 50 = b.s_suppkey - 50 AND b.s_suppkey >= 50 UNION ALL SELECT a.s_suppkey, -1 FROM supplier a WHERE NOT EXISTS (SELECT 1 FROM supplier b WHERE b.s_suppkey >= 50 AND a.s_suppkey % 50 = b.s_suppkey - 50)")
def tile_pairing(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("source"), (F.col("s_suppkey") % 50).alias("tile"))
    t = table(spark, d, "supplier").filter("s_suppkey >= 50").select(F.col("s_suppkey").alias("target"), (F.col("s_suppkey") - 50).alias("tile"))
    return names.paired(s, t, "tile", strict=False).select("source", "target").fillna(-1)


@query("sidecar_pairing", "SELECT s_suppkey % 20 AS tile, count(*) FILTER (s_suppkey % 2 = 0) AS trees, count(*) FILTER (s_suppkey % 2 = 1) AS info, count(*) FILTER (s_suppkey % 2 = 0) = 1 AND count(*) FILTER (s_suppkey % 2 = 1) = 1 AS paired FROM supplier GROUP BY 1")
def sidecar_pairing(spark, d):
    s = table(spark, d, "supplier").select((F.col("s_suppkey") % 20).alias("tile"), F.when(F.col("s_suppkey") % 2 == 0, "trees").otherwise("info").alias("kind"))
    return names.sidecars(s, "tile", "kind", ["trees", "info"])


@query("twin_validation", f"WITH {L}, a AS (SELECT inst % 10 AS key, count(*) AS n, min(X) AS lo, max(X) AS hi FROM L WHERE inst % 10 != 3 GROUP BY 1), b AS (SELECT inst % 10 AS key, count(*) AS n, min(X) + inst % 10 AS lo, max(X) AS hi FROM L WHERE inst % 10 != 7 GROUP BY 1) SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL OR b.key IS NULL THEN 'missing' WHEN a.n != b.n THEN 'count' WHEN abs(a.lo - b.lo) > 5 OR abs(a.hi - b.hi) > 5 THEN 'bounds' ELSE 'same' END AS status FROM a FULL JOIN b ON a.key = b.key")
def twin_validation(spark, d):
    p = cloud(spark, d, "L").withColumn("key", F.col("inst") % 10)
    side = p.groupBy("key").agg(F.count("*").alias("n"), F.min("X").alias("lo"), F.max("X").alias("hi"))
    return names.twins(side.filter("key != 3"), side.filter("key != 7").withColumn("lo", F.col("lo") + F.col("key")), 5)


@query("layout_json", "SELECT 1 AS tiles_total, CAST(2 AS BIGINT) AS cols, CAST(40 AS DOUBLE) AS buffer")
def layout_json(spark, d):
    doc = '{"tile_buffer": 40.0, "tiles": [{"col": 2, "row": 1, "core": [[0, 200], [0, 200]], "bounds": [[-40, 240], [-40, 240]]}]}'
    schema = "tile_buffer double, tiles array<struct<col:long,row:long,core:array<array<double>>,bounds:array<array<double>>>>"
    j = spark.range(1).select(F.from_json(F.lit(doc), schema).alias("j"))
    t = j.select("j.tile_buffer", F.explode("j.tiles").alias("t"))
    return t.agg(F.count("*").cast("int").alias("tiles_total"), F.max("t.col").alias("cols"), F.max(F.col("t.core")[0][0] - F.col("t.bounds")[0][0]).alias("buffer"))


@query("rates_tumbling", "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def rates_tumbling(spark, d):
    """The batch form of the streaming count: the same plan runs over a stream."""
    return windows.counts(table(spark, d, "events"), "1 day").select(F.date_format("start", "yyyy-MM-dd").alias("start"), "event_type", "n")


@query("stream_instance_stats", f"WITH {V} SELECT inst, count(*) AS n, min(X) AS min_x, max(X) AS max_x, CAST(sum(X) AS BIGINT) AS sum_x FROM V GROUP BY inst")
def stream_instance_stats(spark, d):
    return windows.running_statistics(cloud(spark, d, "V"))


@query("stream_exact_duplicates", f"WITH {V} SELECT count(*) AS n FROM (SELECT DISTINCT X, Y, Z FROM V)")
def stream_exact_duplicates(spark, d):
    return windows.exact_once(cloud(spark, d, "V").withColumn("ts", F.timestamp_micros("gps")), "ts", "1 hour").agg(F.count("*").alias("n"))
