"""What the operators of this subpackage share: shared storage, and Arrow batches in and out of Python workers."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxstrata.operators.lineage import shared_dir

#: Characters of text handed to a function at once, unless a single text is longer.
BATCH_CHARS = 4_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: lost executors then recompute nothing above it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: list) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about BATCH_CHARS characters together."""
    start = held = 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= BATCH_CHARS:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def rested() -> None:
    """Gives a worker's free memory back; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def arrow_type(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_lists(df: DataFrame, schema: str | T.StructType, make: Callable[[], Callable[..., list[list]]], text: int | None = 1) -> DataFrame:
    """Apply a function from lists of columns to lists of columns, batch by batch.

    ``make`` is called once per task and returns the function; ``text`` is the position of the column
    whose length bounds a batch (None: batches as they come). Row order and partitioning stay.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    out = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            texts = columns[text].to_pylist() if text is not None else [None] * batch.num_rows
            for a, b in slices(texts) if text is not None else ([(0, len(texts))] if texts else []):
                given = [texts[a:b] if i == text else c.slice(a, b - a).to_pylist() for i, c in enumerate(columns)]
                made = apply(*given)
                yield pa.record_batch([pa.array(x, type=t) for x, t in zip(made, out.types, strict=True)], schema=out)
        rested()

    return df.mapInArrow(run, schema)


def text_batches(batches: Iterator[pa.RecordBatch], text: int = 1, most: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, unless a single text is longer."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to
    rested()


def id_and_text(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    """The two columns alone, under fixed names: whatever else the table holds can't clash. Null text counts as empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)
