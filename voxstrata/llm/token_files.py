"""Token ids as flat unsigned files with 64-bit document offsets, read back through memory maps.

The documents are range-partitioned and sorted by id. Each task writes one pair of files into the shared folder:

* ``part-P-A.tok``: the ids of its documents, one after the other, as flat little-endian unsigned integers (16 bits
  where the vocabulary allows, else 32);
* ``part-P-A.off``: per document three 64-bit integers: its id, 1 if that id isn't null, and where its ids end.

``A`` is the task attempt, so an attempt that was lost leaves nothing that is read. One manifest row per partition goes
to the driver; the partitions' bases are the prefix sums of their id counts. Reading maps one pair of files at a time;
in a store without maps it reads one document's range at a time.

Defined results: a null text counts as empty (its end id alone is written); documents of equal id stand in the order of
their texts' hashes; an id that is null sorts first; an empty table gives no files and no rows; other columns are ignored;
a text is written whole, whatever its length; an id of more than the file's width is an error, never wrapped.
Rows of one id all go to one partition, in bounded batches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, new_path, text_batches
from .subwords import subwords

MANIFEST = "part int, name string, n_docs long, n_ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
#: Documents read from a map before a batch of rows goes out.
READ_DOCS = 20_000


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def id_width(tokenizer: str, end_id: int) -> int:
    """Bytes of an id: two where all ids of the vocabulary and the end fit, else four."""
    return 2 if max(subwords(tokenizer).largest, end_id) < 1 << 16 else 4


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[dict], int]:
    """Write the files; returns the manifest in document order, each row with its ``base``, and the bytes of an id."""
    width = id_width(tokenizer, end_id)
    ordered = id_and_text(docs, id_col, text_col)
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, encoder = TaskContext.get(), subwords(tokenizer)
        name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
        disk, path = open_folder(folder)
        disk.create_dir(path, recursive=True)
        n_docs = at = 0
        with disk.open_output_stream(f"{path}/{name}.tok") as ids_file, disk.open_output_stream(f"{path}/{name}.off") as index:
            for batch in text_batches(batches):
                ids, ends = encoder.flat(batch.column(1))
                line = np.insert(ids, ends, end_id)
                if line.max(initial=0) >> (8 * width):
                    raise OverflowError(f"an id doesn't fit {width} bytes")
                ends = at + ends + np.arange(1, len(ends) + 1)
                ids_file.write(line.astype(f"<u{width}").tobytes())
                keys = batch.column(0)
                rows = np.stack([keys.fill_null(0).to_numpy(zero_copy_only=False), keys.is_valid().to_numpy(zero_copy_only=False), ends], axis=1)
                index.write(rows.astype("<i8").tobytes())
                n_docs, at = n_docs + len(ends), int(ends[-1])
        if n_docs:
            yield pa.record_batch([pa.array([task.partitionId()], pa.int32()), pa.array([name]), pa.array([n_docs]), pa.array([at])], names=["part", "name", "n_docs", "n_ids"])

    rows = sorted((r.asDict() for r in ordered.mapInArrow(write, MANIFEST).collect()), key=lambda r: r["part"])
    bases = accumulate((r["n_ids"] for r in rows), initial=0)
    return [r | {"base": base} for r, base in zip(rows, bases, strict=False)], width


class Flat:
    """A file of equal items: mapped where the folder is a file system of this machine, else read range by range."""

    def __init__(self, disk: pafs.FileSystem, path: str, kind: str):
        self.kind, self.size = np.dtype(kind), disk.get_file_info(path).size // np.dtype(kind).itemsize
        self.map = np.memmap(path, kind, "r") if isinstance(disk, pafs.LocalFileSystem) and self.size else None
        self.file = None if self.map is not None else disk.open_input_file(path)

    def items(self, start: int, end: int) -> np.ndarray:
        if self.map is not None:
            return self.map[start:end]
        self.file.seek(start * self.kind.itemsize)
        return np.frombuffer(self.file.read((end - start) * self.kind.itemsize), self.kind)


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict], width: int) -> DataFrame:
    """Per document its id, where its ids start among all, how many they are and their CRC-32, all from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, path = open_folder(folder)
        for batch in batches:
            for part in batch.to_pylist():
                ids, index = Flat(disk, f"{path}/{part['name']}.tok", f"<u{width}"), Flat(disk, f"{path}/{part['name']}.off", "<i8")
                before = 0
                for a in range(0, index.size // 3, READ_DOCS):
                    rows = index.items(3 * a, min(index.size, 3 * (a + READ_DOCS))).reshape(-1, 3)
                    ends = rows[:, 2]
                    first = np.concatenate([[before], ends[:-1]])
                    sums = [zlib.crc32(ids.items(s, e).astype("<u4").tobytes()) for s, e in zip(first.tolist(), ends.tolist(), strict=True)]
                    before = int(ends[-1])
                    yield pa.record_batch([pa.array(rows[:, 0], mask=rows[:, 1] == 0), pa.array(first + part["base"]), pa.array(ends - first), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    listed = spark.createDataFrame([(r["name"], r["base"]) for r in manifest], "name string, base long")
    return listed.repartition(max(1, len(manifest))).mapInArrow(read, READ)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, **columns) -> DataFrame:
    """Write all documents' ids and return what the files hold."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    return read_token_files(spark, folder, *write_token_files(docs, folder, tokenizer, end_id, **columns))
