"""Uncompressed LAS files as a Python data source: headers, chunked point records, and a writer.

``spark.read.format("las").load(path)`` gives one row per point with the raw lattice integers; a file is split into ranges
of records, so its size doesn't bound a task. ``las_headers`` reads only the first bytes of each file. Compressed variants
need a codec that isn't present and are refused.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Record lengths of point formats, and the fields read from each (fixed values of the format).
LENGTHS = {0: 20, 1: 28, 2: 26, 3: 34, 6: 30, 7: 36, 8: 38}
GPS_AT = {1: 20, 3: 20, 6: 22, 7: 22, 8: 22}
POINTS = "file string, pid long, X int, Y int, Z int, intensity int, return_number int, classification int, gps_time double"
HEADERS = "file string, version string, point_format int, record_length int, n long, scale array<double>, offset array<double>, mins array<double>, maxs array<double>, compressed boolean"
RANGE = 1_000_000


@dataclass
class Header:
    version: str
    point_format: int
    record_length: int
    count: int
    start: int
    scale: tuple
    offset: tuple
    mins: tuple
    maxs: tuple
    compressed: bool


def parse_header(raw: bytes) -> Header:
    if raw[:4] != b"LASF" or len(raw) < 227:
        raise ValueError("no LAS header")
    major, minor = raw[24], raw[25]
    start, _, kind, length, count = struct.unpack_from("<IIBHI", raw, 96)
    scale, offset = struct.unpack_from("<3d", raw, 131), struct.unpack_from("<3d", raw, 155)
    x1, x0, y1, y0, z1, z0 = struct.unpack_from("<6d", raw, 179)
    if (major, minor) >= (1, 4) and len(raw) >= 255:
        (wide,) = struct.unpack_from("<Q", raw, 247)
        count = wide or count
    return Header(f"{major}.{minor}", kind & 0x3F, length, count, start, scale, offset, (x0, y0, z0), (x1, y1, z1), bool(kind & 0x80))


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def files_of(path: str, ending: str) -> list[str]:
    """A file, or the files of a folder with an ending, sorted by name without regard to case."""
    disk, place = _open(path)
    info = disk.get_file_info(place)
    if info.type == pafs.FileType.File:
        return [path]
    found = disk.get_file_info(pafs.FileSelector(place))
    prefix = path.rstrip("/")
    return sorted((f"{prefix}/{f.base_name}" for f in found if f.base_name.lower().endswith(ending)), key=lambda p: (p.lower(), p))


def read_header(path: str) -> Header:
    disk, place = _open(path)
    with disk.open_input_file(place) as file:
        return parse_header(file.read(375))


def record_type(header: Header) -> np.dtype:
    """The fields that are read, at their places in a record."""
    new = header.point_format >= 6
    names = ["X", "Y", "Z", "intensity", "returns", "classification"]
    kinds, places = ["<i4", "<i4", "<i4", "<u2", "u1", "u1"], [0, 4, 8, 12, 14, 16 if new else 15]
    if header.point_format in GPS_AT:
        names, kinds, places = [*names, "gps_time"], [*kinds, "<f8"], [*places, GPS_AT[header.point_format]]
    return np.dtype({"names": names, "formats": kinds, "offsets": places, "itemsize": header.record_length})


class LasRange(InputPartition):
    def __init__(self, path: str, first: int, count: int):
        self.path, self.first, self.count = path, first, count


class LasReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[LasRange]:
        out = []
        for path in files_of(self.path, ".las"):
            header = read_header(path)
            if header.compressed:
                raise ValueError(f"{path}: compressed point data")
            out += [LasRange(path, i, min(self.size, header.count - i)) for i in range(0, header.count, self.size)]
        return out or [LasRange("", 0, 0)]

    def read(self, part: LasRange) -> Iterator[pa.RecordBatch]:
        if not part.count:
            return
        header = read_header(part.path)
        kind = record_type(header)
        disk, place = _open(part.path)
        with disk.open_input_file(place) as file:
            for a in range(part.first, part.first + part.count, 100_000):
                n = min(100_000, part.first + part.count - a)
                rows = np.frombuffer(file.read_at(n * header.record_length, header.start + a * header.record_length), kind)
                if len(rows) != n:
                    raise ValueError(f"{part.path}: cut off")
                mask = 15 if header.point_format >= 6 else 7
                cls = rows["classification"] if header.point_format >= 6 else rows["classification"] & 31
                gps = pa.array(rows["gps_time"]) if "gps_time" in kind.names else pa.nulls(n, pa.float64())
                columns = [pa.array([part.path] * n), pa.array(np.arange(a, a + n)), *(pa.array(rows[c]) for c in "XYZ"), *(pa.array(x.astype("i4")) for x in (rows["intensity"], rows["returns"] & mask, cls)), gps]
                yield pa.record_batch(columns, names=[x.split()[0] for x in POINTS.split(", ")])


@dataclass
class Written(WriterCommitMessage):
    path: str


class LasWriter(DataSourceWriter):
    """One file of point format 6, version 1.4, per task; they appear under their names only when all are written."""

    def __init__(self, path: str, scale: tuple, offset: tuple):
        self.path, self.scale, self.offset = path, scale, offset

    def write(self, rows) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        out = [(r["X"], r["Y"], r["Z"], _get(r, "intensity", 0), (_get(r, "return_number", 1) or 1) | 16, _get(r, "classification", 0), _get(r, "gps_time", 0.0) or 0.0) for r in rows]
        disk, place = _open(self.path)
        disk.create_dir(place, recursive=True)
        name = f"{place}/_part-{task.partitionId():05d}-{task.taskAttemptId()}.tmp"
        with disk.open_output_stream(name) as file:
            file.write(las_bytes(out, self.scale, self.offset))
        return Written(name if out else "")

    def commit(self, messages) -> None:
        disk, place = _open(self.path)
        for i, m in enumerate(x for x in messages if x and x.path):
            disk.move(m.path, f"{place}/part-{i:05d}.las")

    def abort(self, messages) -> None:
        disk, _ = _open(self.path)
        for m in messages:
            if m and m.path:
                disk.delete_file(m.path)


def _get(row, name: str, default):
    return row[name] if name in row.__fields__ and row[name] is not None else default


def las_bytes(points: list[tuple], scale: tuple, offset: tuple) -> bytes:
    kind = np.dtype({"names": ["X", "Y", "Z", "intensity", "returns", "classification", "gps_time"], "formats": ["<i4", "<i4", "<i4", "<u2", "u1", "u1", "<f8"], "offsets": [0, 4, 8, 12, 14, 16, 22], "itemsize": 30})
    rows = np.zeros(len(points), kind)
    if points:
        for name, column in zip(kind.names, zip(*points, strict=True), strict=True):
            rows[name] = column
    lo = [float(rows[a].min()) * s + o if points else 0.0 for a, s, o in zip("XYZ", scale, offset, strict=True)]
    hi = [float(rows[a].max()) * s + o if points else 0.0 for a, s, o in zip("XYZ", scale, offset, strict=True)]
    head = bytearray(375)
    head[0:4], head[24], head[25] = b"LASF", 1, 4
    struct.pack_into("<HIIBHI", head, 94, 375, 375, 0, 6, 30, 0)
    struct.pack_into("<3d3d", head, 131, *scale, *offset)
    struct.pack_into("<6d", head, 179, hi[0], lo[0], hi[1], lo[1], hi[2], lo[2])
    struct.pack_into("<Q", head, 247, len(points))
    return bytes(head) + rows.tobytes()


class LasSource(DataSource):
    """Options: path; ``range`` (records per task); ``scale`` and ``offset`` (three numbers, comma-separated) for writing."""

    @classmethod
    def name(cls) -> str:
        return "las"

    def schema(self) -> str:
        return POINTS

    def reader(self, schema) -> LasReader:
        return LasReader(self.options["path"], int(self.options.get("range", RANGE)))

    def writer(self, schema, overwrite: bool) -> LasWriter:
        three = lambda k, d: tuple(float(x) for x in self.options.get(k, d).split(","))
        disk, place = _open(self.options["path"])
        if not overwrite and disk.get_file_info(place).type != pafs.FileType.NotFound and files_of(self.options["path"], ".las"):
            raise ValueError("the destination holds point files already")
        return LasWriter(self.options["path"], three("scale", "0.001,0.001,0.001"), three("offset", "0,0,0"))


def las_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of a folder: only the first bytes of each are read, on the executors."""
    listed = spark.createDataFrame([(p,) for p in files_of(path, ".las")], "file string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            heads = [read_header(p) for p in names]
            columns = [names, *([getattr(h, a) for h in heads] for a in ("version", "point_format", "record_length", "count", "scale", "offset", "mins", "maxs", "compressed"))]
            types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.float64())] * 4, pa.bool_()]
            yield pa.record_batch([pa.array([list(x) if isinstance(x, tuple) else x for x in c], t) for c, t in zip(columns, types, strict=True)], names=[x.split()[0] for x in HEADERS.split(", ")])

    return listed.repartition(max(1, min(listed.count(), 64))).mapInArrow(read, HEADERS)


def safe_encoding(headers: DataFrame) -> tuple[tuple, tuple]:
    """The finest scale of all files and offsets that keep their union within 32 bits."""
    from pyspark.sql import functions as F

    row = headers.agg(*(F.min(F.get("scale", F.lit(i))).alias(f"s{i}") for i in range(3)), *(F.min(F.get("mins", F.lit(i))).alias(f"l{i}") for i in range(3)), *(F.max(F.get("maxs", F.lit(i))).alias(f"h{i}") for i in range(3))).first()
    scale = tuple(row[f"s{i}"] for i in range(3))
    offset = tuple(float(np.floor((row[f"l{i}"] + row[f"h{i}"]) / 2)) for i in range(3))
    for i in range(3):
        if max(abs(row[f"l{i}"] - offset[i]), abs(row[f"h{i}"] - offset[i])) / scale[i] > (1 << 31) - 1:
            raise OverflowError("the union doesn't fit 32 bits at the finest scale")
    return scale, offset
