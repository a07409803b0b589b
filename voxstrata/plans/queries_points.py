"""Points, tiles, voxels and nearest joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxstrata.functions import lattice
from voxstrata.operators import grid, nearest, voxel
from voxstrata.plans.catalogue import query
from voxstrata.plans.clouds import SQL, TILES, cloud, d2_sql, dense_sql, floor_sql, frame, layout, rect_sql, tiles_sql

E, V, L = SQL["E"], SQL["V"], SQL["L"]
R2 = 10_000  # squared reach on E
V2 = 10_000  # squared reach on V
KEYS = ", ".join(f"{floor_sql(a, '{r}')} AS k{a.lower()}" for a in "XYZ")
MEAN = ", ".join(f"CAST(round_even(CAST(sum({a}) AS DOUBLE) / count(*), 0) AS BIGINT) AS {a}" for a in "XYZ")


def vox(r: int | str) -> str:
    return KEYS.replace("{r}", str(r))


@query("points_decode", f"WITH {E} SELECT pid, X, Y, Z, round(X * 0.001::DOUBLE + 500000, 3) AS dx, round(Y * 0.001::DOUBLE + 5400000, 3) AS dy, round(Z * 0.001::DOUBLE, 3) AS dz FROM E")
def points_decode(spark, d):
    offsets = {"X": "500000", "Y": "5400000", "Z": "0"}
    return cloud(spark, d, "E").select("pid", "X", "Y", "Z", *(F.round(lattice.decoded(a, "0.001", o), 3).alias(f"d{a.lower()}") for a, o in offsets.items()))


BOX = ", ".join(f"{f}({a}) AS {f}_{a.lower()}" for a in "XYZ" for f in ("min", "max"))


@query("cloud_extent", f"WITH {L} SELECT {BOX}, count(*) AS n FROM L")
def cloud_extent(spark, d):
    return grid.extent(cloud(spark, d, "L"))


@query("file_headers", f"WITH {L} SELECT file, {BOX}, count(*) AS n FROM L GROUP BY file")
def file_headers(spark, d):
    return grid.headers(cloud(spark, d, "L"))


@query("tile_grid", f"WITH {tiles_sql('E')} SELECT tile, col, row, x0, x1, y0, y1, bx0, bx1, by0, by1 FROM T")
def tile_grid(spark, d):
    return layout(cloud(spark, d, "E"), "E")


@query("tile_neighbors", f"WITH {dense_sql('E')} SELECT tile, coalesce(east, -1) AS east, coalesce(west, -1) AS west, coalesce(north, -1) AS north, coalesce(south, -1) AS south FROM N")
def tile_neighbors(spark, d):
    return grid.neighbors(layout(cloud(spark, d, "E"), "E")).fillna(-1)


@query("tile_neighbors_geometric", f"WITH {dense_sql('E')} SELECT tile, coalesce(east, -1) AS east, coalesce(west, -1) AS west, coalesce(north, -1) AS north, coalesce(south, -1) AS south FROM N")
def tile_neighbors_geometric(spark, d):
    return grid.nearest_neighbors(layout(cloud(spark, d, "E"), "E")).fillna(-1)


@query("tile_overlaps", f"WITH {dense_sql('E')} SELECT * FROM O")
def tile_overlaps(spark, d):
    return grid.overlaps(layout(cloud(spark, d, "E"), "E"))


@query("tile_assign_buffered", f"WITH {dense_sql('E')} SELECT tile, pid, X, Y, Z FROM A")
def tile_assign_buffered(spark, d):
    p = cloud(spark, d, "E")
    return grid.assign_buffered(p.select("pid", "X", "Y", "Z"), frame(p, "E"), *TILES["E"])


@query("core_occupancy", f"WITH {tiles_sql('L')} SELECT T.tile, count(L.X) AS n, count(L.X) > 0 AS kept FROM T LEFT JOIN L ON X BETWEEN x0 AND x1 AND Y BETWEEN y0 AND y1 GROUP BY T.tile")
def core_occupancy(spark, d):
    p = cloud(spark, d, "L")
    return grid.core_occupancy(p.select("X", "Y"), frame(p, "L"), TILES["L"][0])


@query("uncovered_points", f"WITH {tiles_sql('E')} SELECT pid, X, Y FROM E WHERE NOT EXISTS (SELECT 1 FROM T WHERE tile % 3 != 0 AND X BETWEEN x0 AND x1 AND Y BETWEEN y0 AND y1)")
def uncovered_points(spark, d):
    p = cloud(spark, d, "E")
    return grid.uncovered(p.select("pid", "X", "Y"), _some(layout(p, "E")), TILES["E"][0])


def _some(tiles):
    """A layout with holes, on the same grid: the first tile stays for the origin but holds nothing."""
    empty = F.col("tile") % 3 == 0
    return tiles.withColumns({c: F.when(empty & F.lit(c in ("x1", "y1")), F.col(c) - (1 << 40)).otherwise(F.col(c)) for c in ("x0", "x1", "y0", "y1")})


@query("owner_core", f"WITH {tiles_sql('E')} SELECT pid, arg_min(tile, (d, tile)) AS owner, min(d) AS d2 FROM (SELECT pid, tile, {rect_sql('E', 'T')} AS d FROM E, T WHERE tile % 3 != 0) GROUP BY pid")
def owner_core(spark, d):
    p = cloud(spark, d, "E")
    return grid.owner_core(p, layout(p, "E").filter("tile % 3 != 0"))


HALF_OPEN = "(west IS NULL OR X >= x0) AND (east IS NULL OR X < x1) AND (south IS NULL OR Y >= y0) AND (north IS NULL OR Y < y1)"


@query("background_half_open", f"WITH {dense_sql('E')} SELECT tile, pid, X, Y FROM A JOIN N USING (tile) WHERE {HALF_OPEN}")
def background_half_open(spark, d):
    p = cloud(spark, d, "E")
    t = layout(p, "E")
    return grid.owned_background(grid.assign_buffered(p.select("pid", "X", "Y"), t, *TILES["E"]), t, grid.neighbors(t))


@query("inside_overlap", f"WITH {dense_sql('E')} SELECT pid, later, earlier FROM E JOIN O ON X BETWEEN ox0 AND ox1 AND Y BETWEEN oy0 AND oy1")
def inside_overlap(spark, d):
    p = cloud(spark, d, "E")
    guard = lattice.ulp_guard(1 << 31)  # far below a lattice unit, so bounds in whole units hold the same points
    assert guard < 0.5
    tiled = grid.assign_buffered(p.select("pid", "X", "Y"), frame(p, "E"), *TILES["E"]).withColumnRenamed("tile", "later")
    return tiled.join(grid.overlaps(layout(p, "E")), "later").filter(grid.in_rect(F.col("X"), F.col("Y"), "ox0", "ox1", "oy0", "oy1")).select("pid", "later", "earlier")


@query("core_union_mask", f"WITH {dense_sql('E')}, S AS (SELECT later AS tile, earlier AS other FROM O UNION SELECT earlier, later FROM O UNION SELECT tile, tile FROM T) SELECT DISTINCT A.tile, A.pid FROM A JOIN S USING (tile) JOIN T ON T.tile = S.other AND X BETWEEN x0 AND x1 AND Y BETWEEN y0 AND y1")
def core_union_mask(spark, d):
    p = cloud(spark, d, "E")
    t = layout(p, "E")
    o = grid.overlaps(t)
    near = o.select(F.col("later").alias("tile"), F.col("earlier").alias("other")).union(o.select("earlier", "later")).union(t.select("tile", "tile"))
    cores = near.join(t.select(F.col("tile").alias("other"), "x0", "x1", "y0", "y1"), "other").withColumnRenamed("tile", "_t")
    rows = grid.assign_buffered(p.select("pid", "X", "Y"), t, *TILES["E"])
    return rows.join(cores, (F.col("tile") == F.col("_t")) & grid.in_rect(F.col("X"), F.col("Y"), "x0", "x1", "y0", "y1"), "left_semi").select("tile", "pid")


@query("voxel_keys", f"WITH {E} SELECT pid, {floor_sql('X * 2 + 5', 75)} AS kx, {floor_sql('Y * 2 + 5', 75)} AS ky, {floor_sql('Z * 2 + 5', 75)} AS kz FROM E")
def voxel_keys(spark, d):
    return cloud(spark, d, "E").select("pid", *(lattice.voxel_key(a, "0.002", "0.005", "0.075").alias(f"k{a.lower()}") for a in "XYZ"))


@query("voxel_com", f"WITH {E} SELECT kx, ky, kz, count(*) AS n, {MEAN} FROM (SELECT *, {vox(100)} FROM E) GROUP BY kx, ky, kz")
def voxel_com(spark, d):
    return voxel.centers(cloud(spark, d, "E"), 100)


@query("voxel_com_lines", f"WITH {L} SELECT kx, ky, kz, count(*) AS n, {MEAN} FROM (SELECT *, {vox(1000)} FROM L) GROUP BY kx, ky, kz")
def voxel_com_lines(spark, d):
    return voxel.centers(cloud(spark, d, "L"), 1000)


def _multi(cloud_name: str, res: tuple[int, ...], tiled: bool) -> str:
    src = "A JOIN (SELECT T.tile FROM T WHERE EXISTS (SELECT 1 FROM " + cloud_name + " WHERE X BETWEEN x0 AND x1 AND Y BETWEEN y0 AND y1)) USING (tile)" if tiled else cloud_name
    key = "tile, " if tiled else ""
    return " UNION ALL ".join(f"SELECT {key}CAST({r} AS BIGINT) AS res, kx, ky, kz, count(*) AS n, {MEAN} FROM (SELECT *, {vox(r)} FROM {src}) GROUP BY {key}kx, ky, kz" for r in res)


@query("voxel_com_multires", f"WITH {E} {_multi('E', (60, 100, 250), False)}")
def voxel_com_multires(spark, d):
    return voxel.centers_multi(cloud(spark, d, "E"), [60, 100, 250])


@query("tile_voxel_com", f"WITH {tiles_sql('L')}, A AS (SELECT T.tile, L.* FROM L JOIN T ON X BETWEEN bx0 AND bx1 AND Y BETWEEN by0 AND by1) {_multi('L', (500, 2000), True)}")
def tile_voxel_com(spark, d):
    """Flagship: buffered tiles, occupied cores, exact means at two resolutions from one scan."""
    p = cloud(spark, d, "L").select("X", "Y", "Z")
    return voxel.tile_product(p, frame(p, "L"), *TILES["L"], [500, 2000])


@query("original_passthrough", f"WITH {E} SELECT CAST(0 AS BIGINT) AS res, CAST(-99 AS BIGINT) AS kx, CAST(-99 AS BIGINT) AS ky, CAST(-99 AS BIGINT) AS kz, CAST(1 AS BIGINT) AS n, X, Y, Z FROM E UNION ALL {_multi('E', (100,), False)}")
def original_passthrough(spark, d):
    return voxel.centers_multi(cloud(spark, d, "E"), [0, 100]).fillna(-99)


def _rep(src: str, r: int, cols: str, keys: str = "", ties: str = "X, Y, Z") -> str:
    part = f"{keys}kx, ky, kz"
    off = " + ".join(f"(n * {a} - sum({a}) OVER (PARTITION BY {part})) * (n * {a} - sum({a}) OVER (PARTITION BY {part}))" for a in "XYZ")
    return f"SELECT {cols}, kx, ky, kz, n FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY off, {ties}) AS rk FROM (SELECT *, {off} AS off FROM (SELECT *, count(*) OVER (PARTITION BY {part}) AS n FROM (SELECT *, {vox(r)} FROM {src})))) WHERE rk = 1"


@query("voxel_nearest_centroid", f"WITH {E} {_rep('E', 150, 'pid, X, Y, Z', ties='X, Y, Z, pid')}")
def voxel_nearest_centroid(spark, d):
    return voxel.representatives(cloud(spark, d, "E").select("pid", "X", "Y", "Z"), 150, ties=("X", "Y", "Z", "pid"))


@query("instance_voxel_rep", f"WITH {V} {_rep('V', 2000, 'pid, X, Y, Z, inst', 'inst, ', 'X, Y, Z, pid')}")
def instance_voxel_rep(spark, d):
    return voxel.representatives(cloud(spark, d, "V").select("pid", "X", "Y", "Z", "inst"), 2000, ("inst",), ("X", "Y", "Z", "pid"))


@query("voxel_product_pick", f"WITH {V} {_rep('V', 1500, 'pid, file, X, Y, Z, inst, sem, gps', ties='X, Y, Z, pid')}")
def voxel_product_pick(spark, d):
    return voxel.product_picks(cloud(spark, d, "V"), 1500, "gps")


@query("merged_product", f"WITH {V} SELECT file, count(*) AS picked, CAST(sum(n) AS BIGINT) AS points FROM ({_rep('V', 3000, 'file', ties='X, Y, Z, pid')}) GROUP BY file")
def merged_product(spark, d):
    picks = voxel.representatives(cloud(spark, d, "V"), 3000, ties=("X", "Y", "Z", "pid"))
    return picks.groupBy("file").agg(F.count("*").alias("picked"), F.sum("n").alias("points"))


def _near(q: str, b: str, limit: int, cond: str = "TRUE", key: str = "q.pid", order: str = "") -> str:
    return f"SELECT {key}, arg_min(b.pid, ({order}{d2_sql('q', 'b')}, b.pid)) AS b_pid, CAST(arg_min({d2_sql('q', 'b')}, ({order}{d2_sql('q', 'b')}, b.pid)) AS BIGINT) AS d2 FROM {q} q JOIN {b} b ON {d2_sql('q', 'b')} <= {limit} AND {cond} GROUP BY {key}"


def _pick(df, *keys):
    return df.select(*keys, "b_pid", "d2")


@query("nearest_within", f"WITH {E} {_near('E', '(SELECT * FROM E WHERE pid % 2 = 1)', R2, key='q.pid')}")
def nearest_within(spark, d):
    p = cloud(spark, d, "E")
    return _pick(nearest.nearest(p.select("pid", "X", "Y", "Z"), p.filter("pid % 2 = 1").select("pid", "X", "Y", "Z"), R2, ("pid",)), "pid")


@query("nearest_events", f"WITH {V} {_near('V', '(SELECT * FROM V WHERE sem = 0)', V2, key='q.pid')}")
def nearest_events(spark, d):
    p = cloud(spark, d, "V")
    return _pick(nearest.nearest(p.select("pid", "X", "Y", "Z"), p.filter("sem = 0").select("pid", "X", "Y", "Z"), V2, ("pid",)), "pid")


@query("nearest_same_label", f"WITH {E} {_near('E', 'E', 4 * R2, 'q.inst = b.inst AND q.pid != b.pid', 'q.pid')}")
def nearest_same_label(spark, d):
    p = cloud(spark, d, "E").select("pid", "X", "Y", "Z", "inst")
    return _pick(nearest.nearest(p, p, 4 * R2, ("pid",), on=("inst",), where=F.col("q_pid") != F.col("b_pid")), "pid")


@query("nearest_tree_preferred", f"WITH {E} {_near('E', 'E', R2, 'q.pid != b.pid', 'q.pid', 'CASE WHEN b.inst = 0 THEN 1 ELSE 0 END, ')}")
def nearest_tree_preferred(spark, d):
    p = cloud(spark, d, "E").select("pid", "X", "Y", "Z", "inst")
    return _pick(nearest.nearest(p, p, R2, ("pid",), first=((F.col("b_inst") == 0).cast("int"),), where=F.col("q_pid") != F.col("b_pid")), "pid")


@query("nearest_positive", f"WITH {E} {_near('E', '(SELECT * FROM E WHERE inst > 0)', R2, key='q.pid')}")
def nearest_positive(spark, d):
    p = cloud(spark, d, "E")
    return _pick(nearest.nearest(p.select("pid", "X", "Y", "Z"), p.filter("inst > 0").select("pid", "X", "Y", "Z"), R2, ("pid",)), "pid")


def _by_tile(cond: str, limit: int) -> str:
    o = f"({d2_sql('q', 'b')}, b.tile, b.pid)"
    return f"SELECT q.tile, q.pid, arg_min(b.tile, {o}) AS b_tile, arg_min(b.pid, {o}) AS b_pid, CAST(min({d2_sql('q', 'b')}) AS BIGINT) AS d2 FROM D q JOIN D b ON {d2_sql('q', 'b')} <= {limit} AND {cond} GROUP BY q.tile, q.pid"


def _dense(spark, d):
    from voxstrata.plans.clouds import dense

    p = cloud(spark, d, "E")
    t = layout(p, "E")
    return dense(p, t, "E"), t


@query("nearest_earlier_tile", f"WITH {dense_sql('E')} {_by_tile('b.tile < q.tile', 2500)}")
def nearest_earlier_tile(spark, d):
    rows = _dense(spark, d)[0].select("tile", "pid", "X", "Y", "Z")
    return nearest.nearest(rows, rows, 2500, ("tile", "pid"), where=F.col("b_tile") < F.col("q_tile")).select("tile", "pid", "b_tile", "b_pid", "d2")


@query("nearest_in_overlap", f"WITH {dense_sql('E')} {_by_tile('b.tile < q.tile AND EXISTS (SELECT 1 FROM O WHERE later = q.tile AND earlier = b.tile AND q.X BETWEEN ox0 AND ox1 AND q.Y BETWEEN oy0 AND oy1 AND b.X BETWEEN ox0 AND ox1 AND b.Y BETWEEN oy0 AND oy1)', 2500)}")
def nearest_in_overlap(spark, d):
    rows, t = _dense(spark, d)
    rows = rows.select("tile", "pid", "X", "Y", "Z")
    o = grid.overlaps(t)
    found = nearest.pairs(rows, rows, 2500, where=F.col("b_tile") < F.col("q_tile")).join(o, (F.col("later") == F.col("q_tile")) & (F.col("earlier") == F.col("b_tile")))
    found = found.filter(grid.in_rect(F.col("q_X"), F.col("q_Y"), "ox0", "ox1", "oy0", "oy1") & grid.in_rect(F.col("b_X"), F.col("b_Y"), "ox0", "ox1", "oy0", "oy1"))
    best = found.groupBy(F.col("q_tile").alias("tile"), F.col("q_pid").alias("pid")).agg(F.min(F.struct("d2", "b_tile", "b_pid")).alias("m"))
    return best.select("tile", "pid", "m.b_tile", "m.b_pid", "m.d2")


def _exists(neg: str) -> str:
    return f"WITH {E} SELECT q.pid FROM E q WHERE {neg} EXISTS (SELECT 1 FROM E b WHERE b.inst > 0 AND b.pid % 2 = 1 AND {d2_sql('q', 'b')} <= {R2})"


def _probe(spark, d):
    p = cloud(spark, d, "E")
    return p.select("pid", "X", "Y", "Z"), p.filter("inst > 0 AND pid % 2 = 1").select("pid", "X", "Y", "Z")


@query("covered_by_tree", _exists(""))
def covered_by_tree(spark, d):
    q, b = _probe(spark, d)
    return nearest.exists_within(q, b, R2, ("pid",)).select("pid")


@query("uncovered_by_tree", _exists("NOT"))
def uncovered_by_tree(spark, d):
    q, b = _probe(spark, d)
    return nearest.not_exists_within(q, b, R2, ("pid",)).select("pid")


def _coverage(by: str) -> str:
    bins = "CAST(count_if(d2 = 0) AS BIGINT) AS bin0, " + ", ".join(f"CAST(count_if(sqrt(d2) > {25 * k} AND d2 <= {(25 * (k + 1)) ** 2} AND d2 > 0) AS BIGINT) AS bin{k + 1}" for k in range(4))
    g = f"{by}, " if by else ""
    return f"WITH {E}, m AS (SELECT q.file, q.pid, (SELECT min({d2_sql('q', 'b')}) FROM E b WHERE b.pid % 2 = 1 AND {d2_sql('q', 'b')} <= {R2}) AS d2 FROM E q) SELECT {g}count(*) AS total, count(d2) AS matched, CAST(max(d2) AS BIGINT) AS max_d2, {bins} FROM m" + (f" GROUP BY {by}" if by else "")


def _matched(spark, d):
    p = cloud(spark, d, "E")
    best = nearest.nearest(p.select("pid", "X", "Y", "Z"), p.filter("pid % 2 = 1").select("pid", "X", "Y", "Z"), R2, ("pid",)).select("pid", "d2")
    return p.join(best, "pid", "left")


@query("coverage_histogram", _coverage(""))
def coverage_histogram(spark, d):
    return nearest.coverage(_matched(spark, d), R2)


@query("coverage_by_file", _coverage("file"))
def coverage_by_file(spark, d):
    return nearest.coverage(_matched(spark, d), R2, ("file",))


@query("encode_range_check", f"WITH {E} SELECT pid, X * 10000000 BETWEEN -2147483648 AND 2147483647 AS fits, CAST(round_even(X * 0.001::DOUBLE / 0.002::DOUBLE, 0) AS INTEGER) AS raw FROM E")
def encode_range_check(spark, d):
    return cloud(spark, d, "E").select("pid", lattice.fits_int32(F.col("X") * 10_000_000).alias("fits"), lattice.encoded(F.col("X") * 0.001, "0.002", "0").alias("raw"))


@query("hypot_distance", f"WITH {E} SELECT pid, round(sqrt(X * X + Y * Y), 6) AS h, round(sqrt(X * X + Y * Y + Z * Z), 6) AS r FROM E")
def hypot_distance(spark, d):
    x, y, z = (F.col(a).cast("double") for a in "XYZ")
    return cloud(spark, d, "E").select("pid", F.round(F.hypot(x, y), 6).alias("h"), F.round(F.sqrt(x * x + y * y + z * z), 6).alias("r"))


@query("cell_histogram", f"WITH {V} SELECT {floor_sql('X', 2000)} AS cx, {floor_sql('Y', 2000)} AS cy, count(*) AS n FROM V GROUP BY 1, 2")
def cell_histogram(spark, d):
    return cloud(spark, d, "V").groupBy(lattice.floor_div("X", 2000).alias("cx"), lattice.floor_div("Y", 2000).alias("cy")).agg(F.count("*").alias("n"))


@query("occupied_cells", f"WITH {V} SELECT DISTINCT {vox(2000)} FROM V WHERE inst > 0")
def occupied_cells(spark, d):
    return voxel.with_voxels(cloud(spark, d, "V").filter("inst > 0"), 2000).select("kx", "ky", "kz").distinct()


@query("morton_code", "WITH " + E + " SELECT pid, CAST(" + " + ".join(f"((({a} + 1000) >> {i}) & 1) * {1 << (3 * i + k)}" for i in range(11) for k, a in enumerate("XYZ")) + " AS BIGINT) AS code FROM E")
def morton_code(spark, d):
    return cloud(spark, d, "E").select("pid", lattice.morton3(*(F.col(a) + 1000 for a in "XYZ"), bits=11).alias("code"))


ANCHORS = "SELECT inst, CAST(round_even(CAST(sum(X) AS DOUBLE) / count(*), 0) AS BIGINT) AS X, CAST(round_even(CAST(sum(Y) AS DOUBLE) / count(*), 0) AS BIGINT) AS Y FROM E WHERE inst > 0 GROUP BY inst"


@query("instance_tiles", f"WITH {tiles_sql('E')}, K AS ({ANCHORS}), W AS (SELECT K.inst, arg_min(T.tile, ({rect_sql('K', 'T')}, T.tile)) AS tile FROM K, T GROUP BY K.inst), B AS (SELECT E.pid, arg_min(T.tile, ({rect_sql('E', 'T')}, T.tile)) AS tile FROM E, T WHERE inst = 0 GROUP BY E.pid), J AS (SELECT W.tile, E.* FROM E JOIN W USING (inst) UNION ALL SELECT B.tile, E.* FROM E JOIN B USING (pid)) {_rep('J', 150, 'tile, pid, inst', 'tile, inst, ', 'X, Y, Z, pid')}")
def instance_tiles(spark, d):
    p = cloud(spark, d, "E")
    return grid.instance_tiles(p.select("pid", "X", "Y", "Z", "inst"), layout(p, "E"), 150).select("tile", "pid", "inst", "kx", "ky", "kz", "n")


@query("file_layout_match", f"WITH {tiles_sql('E')} SELECT tile AS file, tile FROM T")
def file_layout_match(spark, d):
    """Files whose bounds are a little off find their tile again."""
    rows = layout(cloud(spark, d, "E"), "E").orderBy("tile").collect()
    tiles = [(r.x0, r.x1, r.y0, r.y1) for r in rows]
    files = [(a + 0.4 * (i % 3), b - 1.5 * (i % 2), c, e + 0.05) for i, (a, b, c, e) in enumerate(tiles)]
    found = grid.match_files(files, tiles)
    return spark.createDataFrame([(rows[i].tile, rows[t].tile) for i, t in sorted(found.items())], "file long, tile long")
