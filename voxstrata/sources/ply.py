"""Binary PLY: meshes as vertices and faces, and points; strict headers, sizes checked."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxstrata.sources.las import _open, files_of

TYPES = {"float64": "<f8", "double": "<f8", "float": "<f4", "float32": "<f4", "int": "<i4", "int32": "<i4", "uint": "<u4", "uint32": "<u4", "short": "<i2", "ushort": "<u2", "uchar": "u1", "uint8": "u1", "char": "i1", "int8": "i1"}
VERTICES = "mesh string, vid long, x double, y double, z double"
FACES = "mesh string, fid long, v0 long, v1 long, v2 long, tree_id long"


def parse_header(raw: bytes) -> tuple[list[tuple[str, int, np.dtype]], int, list[str]]:
    """(element, count, record type) in file order, where data begin, and comments."""
    end = raw.find(b"end_header\n")
    lines = raw[:end].decode("latin-1").splitlines() if end >= 0 else []
    if not lines or lines[0] != "ply" or lines[1] != "format binary_little_endian 1.0":
        raise ValueError("no little-endian binary PLY header")
    elements, comments = [], []
    for words in (x.split() for x in lines[2:]):
        if words[0] == "comment":
            comments.append(" ".join(words[1:]))
        elif words[0] == "element":
            elements.append((words[1], int(words[2]), []))
        elif words[0] == "property" and words[1] == "list":
            # triangles only: a count of three and the corners
            elements[-1][2].extend([("count", TYPES[words[2]]), ("corners", TYPES[words[3]], (3,))])
        elif words[0] == "property":
            elements[-1][2].append((words[2], TYPES[words[1]]))
    return [(n, c, np.dtype(f)) for n, c, f in elements], end + len(b"end_header\n"), comments


def _element(path: str, name: str) -> np.ndarray:
    disk, place = _open(path)
    with disk.open_input_file(place) as file:
        elements, at, _ = parse_header(file.read(min(file.size(), 65_536)))
        if at + sum(c * t.itemsize for _, c, t in elements) != file.size():
            raise ValueError(f"{path}: its size isn't what its header says")
        for kind, count, dtype in elements:
            if kind == name:
                return np.frombuffer(file.read_at(count * dtype.itemsize, at), dtype)
            at += count * dtype.itemsize
    return np.empty(0, [])


def _read(spark: SparkSession, path: str, schema: str, columns) -> DataFrame:
    files = files_of(path, ".ply")
    names = [x.split()[0] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                made = columns(p)
                for a in range(0, len(made[0]), 100_000):
                    part = [c[a : a + 100_000] for c in made]
                    yield pa.record_batch([pa.array([p] * len(part[0])), pa.array(np.arange(a, a + len(part[0]))), *part], names=names)

    listed = spark.createDataFrame([(p,) for p in files], "file string")
    return listed.repartition(max(1, len(files))).mapInArrow(read, schema)


def vertices(spark: SparkSession, path: str) -> DataFrame:
    def columns(p: str):
        v = _element(p, "vertex")
        return [pa.array(v[a].astype("f8")) for a in "xyz"]

    return _read(spark, path, VERTICES, columns)


def faces(spark: SparkSession, path: str) -> DataFrame:
    def columns(p: str):
        f = _element(p, "face")
        if len(f) and (f["count"] != 3).any():
            raise ValueError(f"{p}: a face isn't a triangle")
        corners = f["corners"].astype("i8") if len(f) else np.empty((0, 3), "i8")
        tree = pa.array(f["tree_id"].astype("i8")) if len(f) and "tree_id" in f.dtype.names else pa.nulls(len(f), pa.int64())
        return [*(pa.array(corners[:, k]) for k in range(3)), tree]

    return _read(spark, path, FACES, columns)


def mesh_bytes(points: np.ndarray, triangles: np.ndarray, trees: np.ndarray | None = None, comments: tuple[str, ...] = ()) -> bytes:
    """A mesh of float64 corners and int32 triangles; integers that don't fit are refused."""
    if len(triangles) and (triangles.min() < 0 or triangles.max() >= len(points)):
        raise ValueError("a face names no vertex")
    fields = [("count", "u1"), ("corners", "<i4", (3,))] + ([("tree_id", "<u4")] if trees is not None else [])
    rows = np.zeros(len(triangles), fields)
    rows["count"], rows["corners"] = 3, triangles
    if trees is not None:
        if len(trees) and (trees.min() < 0 or trees.max() > 0xFFFFFFFF):
            raise ValueError("an identifier doesn't fit 32 bits")
        rows["tree_id"] = trees
    head = ["ply", "format binary_little_endian 1.0", *(f"comment {c}" for c in comments), f"element vertex {len(points)}", *(f"property double {a}" for a in "xyz"), f"element face {len(triangles)}", "property list uchar int vertex_indices", *(["property uint tree_id"] if trees is not None else []), "end_header"]
    return ("\n".join(head) + "\n").encode() + points.astype("<f8").tobytes() + rows.tobytes()


def write_meshes(verts: DataFrame, tris: DataFrame, folder: str) -> DataFrame:
    """One file per mesh (a mesh is a tile's surface, so it fits a task); returns (mesh, path, vertices, faces)."""
    import pandas as pd

    def save(key, v: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        v = v.sort_values("vid")
        place = {k: i for i, k in enumerate(v["vid"].tolist())}
        corners = np.array([[place[c] for c in r] for r in f.sort_values("fid")[["v0", "v1", "v2"]].to_numpy().tolist()], "i8").reshape(-1, 3)
        disk, root = _open(folder)
        disk.create_dir(root, recursive=True)
        name = f"{root}/mesh-{key[0]}.ply"
        with disk.open_output_stream(name + ".tmp") as out:
            out.write(mesh_bytes(v[["x", "y", "z"]].to_numpy(), corners))
        disk.move(name + ".tmp", name)
        return pd.DataFrame([(str(key[0]), name, len(v), len(f))], columns=["mesh", "path", "vertices", "faces"])

    return verts.groupBy("mesh").cogroup(tris.groupBy("mesh")).applyInPandas(save, "mesh string, path string, vertices long, faces long")


def property_cases(spark: SparkSession, path: str) -> DataFrame:
    """Property names in small letters and as the files spell them."""
    rows = []
    for p in files_of(path, ".ply"):
        disk, place = _open(p)
        with disk.open_input_file(place) as file:
            rows += [(p, e, n.lower(), n) for e, _, t in parse_header(file.read(min(file.size(), 65_536)))[0] for n in t.names]
    return spark.createDataFrame(rows, "file string, element string, folded string, name string").orderBy(F.lower("file"), "element", "name")
