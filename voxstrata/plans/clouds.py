"""The driver's tables read as labelled point clouds: DataFrames, and the same as SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxstrata.operators import grid

#: Tile length, buffer per cloud, in lattice units.
TILES = {"E": (200, 40), "V": (10_000, 1_000), "L": (20_000, 1_000)}

SQL = {
    "E": """E AS (SELECT vec_id AS pid, CAST(vec_id % 2 AS BIGINT) AS file, CAST(round(CAST(embedding[1] AS DOUBLE) * 1000) AS BIGINT) AS X, CAST(round(CAST(embedding[2] AS DOUBLE) * 1000) AS BIGINT) AS Y,
        CAST(round(CAST(embedding[3] AS DOUBLE) * 1000) AS BIGINT) AS Z, CAST(label AS BIGINT) AS inst, CAST(label % 3 AS BIGINT) AS sem FROM embeddings)""",
    "V": """V AS (SELECT event_id AS pid, CAST(user_id % 3 AS BIGINT) AS file, CAST(round(value * 100) AS BIGINT) AS X, CAST(user_id * 100 AS BIGINT) AS Y, CAST(hour(ts) * 60 + minute(ts) AS BIGINT) AS Z,
        CAST(user_id % 50 AS BIGINT) AS inst, CAST(CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS BIGINT) AS sem, CAST(epoch_us(ts) AS BIGINT) AS gps FROM events)""",
    "L": """L AS (SELECT CAST(l_orderkey % 4 AS BIGINT) AS file, CAST(l_partkey * 100 AS BIGINT) AS X, CAST(l_suppkey * 100 AS BIGINT) AS Y, CAST(round(l_quantity * 100) AS BIGINT) AS Z, CAST(l_suppkey AS BIGINT) AS inst FROM lineitem)""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cloud(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    long = lambda c: c.cast("long")
    if name == "E":
        t = table(spark, sf_dir, "embeddings")
        axes = [long(F.round(F.get("embedding", F.lit(i)).cast("double") * 1000)).alias(a) for i, a in enumerate("XYZ")]
        return t.select(F.col("vec_id").alias("pid"), long(F.col("vec_id") % 2).alias("file"), *axes, long(F.col("label")).alias("inst"), long(F.col("label") % 3).alias("sem"))
    if name == "V":
        t = table(spark, sf_dir, "events")
        kinds = ["view", "click", "purchase", "signup"]
        sem = F.coalesce(F.array_position(F.array(*map(F.lit, kinds)), F.col("event_type")), F.lit(0))
        return _dealt(t.select(
            F.col("event_id").alias("pid"), long(F.col("user_id") % 3).alias("file"), long(F.round(F.col("value") * 100)).alias("X"), long(F.col("user_id") * 100).alias("Y"),
            long(F.hour("ts") * 60 + F.minute("ts")).alias("Z"), long(F.col("user_id") % 50).alias("inst"), long(F.when(sem == 0, 4).otherwise(sem - 1)).alias("sem"), F.unix_micros(F.col("ts").cast("timestamp")).alias("gps"),
        ))
    t = table(spark, sf_dir, "lineitem")
    return _dealt(t.select(long(F.col("l_orderkey") % 4).alias("file"), long(F.col("l_partkey") * 100).alias("X"), long(F.col("l_suppkey") * 100).alias("Y"), long(F.round(F.col("l_quantity") * 100)).alias("Z"), long(F.col("l_suppkey")).alias("inst")))


def _dealt(points: DataFrame) -> DataFrame:
    """A table in fewer pieces than there are cores is dealt out once, narrow as it is; larger ones stay as they lie."""
    cores = points.sparkSession.sparkContext.defaultParallelism
    return points.repartition(cores) if points.rdd.getNumPartitions() < cores else points


def frame(points: DataFrame, name: str) -> grid.Frame:
    return grid.frame(points, *TILES[name])


def layout(points: DataFrame, name: str) -> DataFrame:
    return grid.tile_grid(points, *TILES[name])


def dense(points: DataFrame, tiles: DataFrame, name: str) -> DataFrame:
    """Buffered tiles' points with labels of each tile's own: (tile, pid, X, Y, Z, inst, sem)."""
    rows = grid.assign_buffered(points, tiles, *TILES[name])
    local = F.when(F.col("inst") == 0, F.lit(0).cast("long")).otherwise((F.col("inst") + F.col("tile")) % 9 + 1)
    return rows.withColumn("inst", local).select("tile", "pid", "X", "Y", "Z", "inst", "sem")


def tiles_sql(name: str) -> str:
    """CTEs: the cloud, its extent ``x`` and its layout ``T``."""
    length, buffer = TILES[name]
    return f"""{SQL[name]}, x AS (SELECT min(X) AS mx, max(X) AS nx, min(Y) AS my, max(Y) AS ny FROM {name}),
    g AS (SELECT *, greatest(1, CAST(ceil((nx - mx) / {length}.0) AS BIGINT)) AS cols, greatest(1, CAST(ceil((ny - my) / {length}.0) AS BIGINT)) AS rows FROM x),
    c AS (SELECT *, unnest(range(cols)) AS col FROM g), r AS (SELECT *, unnest(range(rows)) AS row FROM c),
    T AS (SELECT col * rows + row AS tile, col, row, mx + col * {length} AS x0, mx + (col + 1) * {length} AS x1, my + row * {length} AS y0, my + (row + 1) * {length} AS y1,
        mx + col * {length} - {buffer} AS bx0, mx + (col + 1) * {length} + {buffer} AS bx1, my + row * {length} - {buffer} AS by0, my + (row + 1) * {length} + {buffer} AS by1 FROM r)"""


def dense_sql(name: str) -> str:
    """More CTEs: ``A`` (points by buffered tile), ``D`` (with local labels), ``O`` (overlaps), ``N`` (neighbours)."""
    return f"""{tiles_sql(name)}, A AS (SELECT T.tile, {name}.* FROM {name} JOIN T ON X BETWEEN bx0 AND bx1 AND Y BETWEEN by0 AND by1),
    D AS (SELECT tile, pid, X, Y, Z, CASE WHEN inst = 0 THEN 0 ELSE (inst + tile) % 9 + 1 END AS inst, sem FROM A),
    O AS (SELECT a.tile AS later, b.tile AS earlier, greatest(a.bx0, b.bx0) AS ox0, least(a.bx1, b.bx1) AS ox1, greatest(a.by0, b.by0) AS oy0, least(a.by1, b.by1) AS oy1
        FROM T a JOIN T b ON b.tile < a.tile AND least(a.bx1, b.bx1) > greatest(a.bx0, b.bx0) AND least(a.by1, b.by1) > greatest(a.by0, b.by0)),
    N AS (SELECT t.*, e.tile AS east, w.tile AS west, n.tile AS north, s.tile AS south FROM T t LEFT JOIN T e ON e.col = t.col + 1 AND e.row = t.row LEFT JOIN T w ON w.col = t.col - 1 AND w.row = t.row
        LEFT JOIN T n ON n.col = t.col AND n.row = t.row + 1 LEFT JOIN T s ON s.col = t.col AND s.row = t.row - 1)"""


def floor_sql(a: str, b: int | str) -> str:
    return f"CAST(floor(CAST({a} AS DOUBLE) / {b}) AS BIGINT)"


def d2_sql(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}.{x} - {b}.{x}) * ({a}.{x} - {b}.{x})" for x in "XYZ") + ")"


def rect_sql(p: str, t: str) -> str:
    """Squared XY distance of a point to a core."""
    d = lambda a: f"greatest({t}.{a.lower()}0 - {p}.{a}, {p}.{a} - {t}.{a.lower()}1, 0)"
    return f"({d('X')} * {d('X')} + {d('Y')} * {d('Y')})"
