"""Publishing results: a staged write that appears at once, reports, fingerprints."""

from __future__ import annotations

import json
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxstrata.sources.las import _open


def publish(df: DataFrame, path: str, *, partition_by: tuple[str, ...] = ()) -> None:
    """Write beside the destination and rename; an existing destination is refused and a failure leaves nothing."""
    disk, place = _open(path)
    if disk.get_file_info(place).type != pafs.FileType.NotFound:
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    try:
        df.write.partitionBy(*partition_by).parquet(staged)
        disk.move(_open(staged)[1], place)
    except BaseException:
        if disk.get_file_info(_open(staged)[1]).type != pafs.FileType.NotFound:
            disk.delete_dir(_open(staged)[1])
        raise


def report(metrics: DataFrame, path: str) -> dict:
    """A small table of metrics as one JSON document."""
    doc = {"rows": [r.asDict(recursive=True) for r in metrics.limit(100_000).collect()]}
    disk, place = _open(path)
    with disk.open_output_stream(place) as file:
        file.write(json.dumps(doc, indent=1, sort_keys=True, default=str).encode())
    return doc


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, sha256) of every file under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def stale(now: DataFrame, staged: DataFrame) -> DataFrame:
    """Sources whose fingerprint (name, length, sha256) isn't that of what was staged."""
    return now.join(staged.select("path", "length", "sha256"), ["path", "length", "sha256"], "left_anti")


def layout_document(tiles: DataFrame, buffer: float) -> str:
    """A layout as JSON: a tile table is small."""
    rows = [r.asDict() for r in tiles.orderBy("tile").collect()]
    sides = lambda r, p: [[r[f"{p}x0"], r[f"{p}x1"]], [r[f"{p}y0"], r[f"{p}y1"]]]
    return json.dumps({"tile_buffer": buffer, "tiles": [{"col": r["col"], "row": r["row"], "core": sides(r, ""), "bounds": sides(r, "b")} for r in rows]})


def job_lines(tiles: DataFrame) -> DataFrame:
    """One text line a tile: its label and the buffered bounds."""
    from voxstrata.functions.names import tile_label

    return tiles.select(F.concat_ws("|", tile_label(F.col("col"), F.col("row")), F.format_string("([%d,%d],[%d,%d])", "bx0", "bx1", "by0", "by1")).alias("value"))


def parsed_jobs(lines: DataFrame) -> DataFrame:
    bound = lambda i: F.regexp_extract("value", r"\(\[(-?\d+),(-?\d+)\],\[(-?\d+),(-?\d+)\]\)", i).cast("long")
    return lines.select(F.element_at(F.split("value", r"\|"), 1).alias("label"), *(bound(i + 1).alias(n) for i, n in enumerate(("bx0", "bx1", "by0", "by1"))))
