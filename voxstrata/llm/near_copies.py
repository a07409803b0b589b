"""Near copies by SimHash tiles and exact Jaccard similarity of word shingles.

A text's lower-cased (A-Z) words give a set of shingles, held as 48 bits of XXH64 hashes. Equal sets are merged first, so copies cost
one row. Candidates come from SimHash fingerprints of ``BITS`` bits (a bit is set if it is set in more than half of the
set's hashes, mixed anew for every 64 bits) by exclusive-or and bit counts over tiles, as in ``simhash``: two texts meet if
their first 64 * ``WORDS`` bits differ in at most ``RADIUS``. Where they meet, the sets decide: two texts are linked only if
their Jaccard similarity is at least ``least``.

At a similarity of 0.8 about 0.15 of the bits differ (0.16 at most, 0.19 for a set of four in one of five), too many for
blocks of which one surely agrees. So tiles are formed inside groups that agree on a block of drawn bits, as many bits as
bring random groups down to ``tile_rows``, and as many blocks as leave a pair that differs in ``SHARE`` of its bits apart in
all of them with chance ``MISS``. A small table is one group. A group of more than twice ``tile_rows`` is dealt by a hash into
salts, and every two salts meet.

What is connected inside a tile group stands in the group of its least row, so like copies, which share most blocks, stand in
one or a few. A group of more than ``tile_bytes`` is dealt in the same way. A group yields a forest of its links, not all
pairs; components then follow from all forests, so a text can be in a component by way of others.

Defined results: null and empty texts are copies of each other; a text of fewer words than a shingle is one shingle;
repeated rows fall together; a null id belongs to its component but is never its id unless all are null; an empty table
gives no rows; texts are read whole; other columns are ignored (``near_copies``) or kept as they are (``first_copies``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_type, rested, stored, text_batches
from .components import components
from .simhash import tiled_forest

BITS, WORDS, RADIUS = 512, 3, 62
SHARE, MISS = 0.17, 1e-6
LOW = np.uint64((1 << 48) - 1)
#: Sets compared in one place hold at most about so many bytes.
TILE_BYTES = 8 << 20
#: Fingerprints in a random group.
TILE_ROWS = 2048
_rnd = np.random.default_rng(1)
_FLIP, _TIMES, _AGAIN = (_rnd.integers(0, 1 << 64, BITS // 64, np.uint64) | np.uint64(1) for _ in range(3))
_HALF = np.uint64(32)


def shingles(text: str, size: int = 5, seed: int = 42) -> np.ndarray:
    """The set as ascending hashes of 48 bits."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends[min(size, len(words)) - 1 :].tolist()
    return np.unique(np.array([digest(line[s:e], seed) for s, e in zip(starts, ends, strict=False)], np.uint64) & LOW)


def packed(hashes: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view("<u8")[:, 0]


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` bits as 64-bit integers."""
    total = np.zeros(BITS, np.int64)
    for a in range(0, len(hashes), 255):  # sums fit a byte
        x = (hashes[a : a + 255, None] ^ _FLIP) * _TIMES
        x ^= x >> _HALF
        x *= _AGAIN
        x ^= x >> _HALF
        total += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)


def blocks(rows: int, tile_rows: int = TILE_ROWS) -> np.ndarray:
    """The places of each block's bits, (blocks, bits); no bits if all rows are one group."""
    bits = min(20, max(0, math.ceil(math.log2(max(1, rows) / tile_rows))))
    many = math.ceil(math.log(MISS) / math.log1p(-((1 - SHARE) ** bits))) if bits else 1
    drawn = np.random.default_rng(2)
    return np.concatenate([drawn.permutation(BITS) for _ in range(1 + many * bits // BITS)])[: many * bits].reshape(many, bits)


def keys(prints: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The number of each block and of its bits, (fingerprints, blocks)."""
    set_bits = np.unpackbits(prints.view(np.uint8), axis=1, bitorder="little")
    many, bits = places.shape
    out = np.tile(np.arange(many, dtype=np.int32) << bits, (len(prints), 1))
    for i in range(bits):
        out += set_bits[:, places[:, i]].astype(np.int32) << i
    return out


def forest(sets: list[np.ndarray], least: float) -> np.ndarray:
    """Per set the index of the first it is linked to, directly or through others; sets of one component aren't compared."""
    sizes, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts, seen = np.cumsum(sizes) - sizes, np.zeros(len(codes), bool)
    for i in range(len(sets) - 1):
        others = i + 1 + np.flatnonzero(root[i + 1 :] != root[i])
        others = others[np.minimum(sizes[others], sizes[i]) / np.maximum(sizes[others], sizes[i]) >= least]
        if not len(others):
            continue
        own = codes[starts[i] : starts[i] + sizes[i]]
        seen[own] = True
        if 4 * len(others) > len(sets):
            both = np.add.reduceat(seen[codes], starts, dtype=np.int64)[others]
        else:
            both = np.array([np.count_nonzero(seen[codes[starts[j] : starts[j] + sizes[j]]]) for j in others])
        seen[own] = False
        for j in others[both / (sizes[i] + sizes[others] - both) >= least]:
            if root[j] != root[i]:
                a, b = sorted((root[i], root[j]))
                root[root == b] = a
    return root


def meetings(distinct: DataFrame, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(head, row) of rows that meet others: what is near in fingerprint meets under one head; ``distinct``: (row, print, keys)."""
    words = [F.col("print")[i].alias(f"w{i}") for i in range(WORDS)]
    rows = distinct.select(F.explode("keys").alias("key"), "row", *words)
    hot = rows.groupBy("key").count().filter(F.col("count") > 2 * tile_rows).select("key", F.ceil(F.col("count") / tile_rows).cast("int").alias("salts"))
    rows = rows.join(hot, "key", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    rows = rows.withColumn("own", F.expr("CAST(pmod(xxhash64(row, key), salts) AS INT)"))
    rows = rows.withColumn("other", F.explode(F.expr("IF(salts = 1, array(0), filter(sequence(0, salts - 1), x -> x != own))")))
    rows = rows.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "row", *(f"w{i}" for i in range(WORDS)))
    dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "row")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def met(table: pa.Table, last: bool) -> tuple[pa.RecordBatch, pa.Table]:
            at = [table.column(i).to_numpy() for i in range(3)]
            row, prints = table.column(3).to_numpy(), np.stack([table.column(4 + i).to_numpy() for i in range(WORDS)], 1).view(np.uint64)
            cuts = [0, *(1 + np.flatnonzero(np.any([x[1:] != x[:-1] for x in at], 0))).tolist(), *([len(row)] if last else [])]
            made = [(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    root = tiled_forest(prints[a:b], RADIUS)
                    least = np.full(b - a, b - a)
                    np.minimum.at(least, root, np.arange(b - a))
                    own = np.flatnonzero(np.bincount(root, minlength=b - a)[root] > 1)
                    made.append((np.full(len(own), at[0][a] if at[2][a] else -1, np.int32), row[a:b][least[root[own]]], row[a:b][own]))
            return pa.record_batch([np.concatenate(x) for x in zip(*made, strict=True)], names=["hot", "head", "row"]), table.slice(cuts[-1])

        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            made, held = met(held, last=False)
            if made.num_rows:
                yield made
        if held is not None and held.num_rows:
            yield met(held, last=True)[0]
        rested()

    found = stored(dealt.mapInArrow(compare, "hot int, head long, row long"), "met")
    met = found.filter("hot < 0").select("head", "row")
    salted = found.filter("hot >= 0").select(F.xxhash64("hot", "head").alias("v"), F.xxhash64("hot", "row").alias("node"), "row")
    if not salted.isEmpty():  # the pairs of salts of one block have one head
        near = salted.select("node", "row").distinct().join(components(salted.select(F.col("node").alias("u"), "v")), "node")
        heads = near.groupBy("root").agg(F.min("row").alias("head"))
        met = met.unionByName(near.join(heads, "root").select("head", "row"))
    return met.distinct()


def links(distinct: DataFrame, texts: DataFrame, least: float, shingle: int, tile_bytes: int = TILE_BYTES, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (u, v) of rows that connect what is linked; ``distinct``: (row, size, print, keys), ``texts``: (row, text).

    Only rows that meet others are hashed again, and only their sets travel to the groups.
    """
    rows = meetings(distinct, tile_rows).join(distinct.select("row", "size"), "row")
    rows = stored(rows, "meetings")
    tiles = rows.groupBy("head").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") * 6 / tile_bytes)).cast("int").alias("salts"))
    rows = rows.join(tiles, "head").withColumn("own", F.expr("CAST(pmod(xxhash64(row, head), salts) AS INT)"))
    rows = rows.withColumn("other", F.explode(F.expr("IF(salts = 1, array(0), filter(sequence(0, salts - 1), x -> x != own))")))
    rows = rows.select("row", F.struct("head", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).alias("group"))
    groups = stored(rows.groupBy("row").agg(F.collect_list("group").alias("groups")), "candidates")  # a row has a group a block at most, or a salt of one
    needed = texts.join(groups.hint("merge"), "row").select("groups", "row", "text")  # one plan at every size
    out = arrow_type(schema := T.StructType([*needed.schema[:2], T.StructField("hashes", T.BinaryType())]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2):
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([packed(shingles(t, shingle)) for t in batch.column(2).to_pylist()], pa.binary())], schema=out)

    dealt = needed.mapInArrow(hashed, schema).select(F.explode("groups").alias("g"), "row", "hashes").select("g.*", "row", "hashes")
    dealt = dealt.repartition("head", "lo", "hi").sortWithinPartitions("head", "lo", "hi", "row")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(run: list[tuple]) -> pa.RecordBatch:
            own = np.array([r for r, _ in run], np.int64)
            root = forest([unpacked(h) for _, h in run], least) if len(run) > 1 else np.zeros(1, np.int64)
            child = np.flatnonzero(root != np.arange(len(run)))
            return pa.record_batch([own[child], own[root[child]]], names=["u", "v"])

        key, held = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *at, row, hashes in zip(*columns, strict=True):
                if at != key:
                    if len(held) > 1:
                        yield edges(held)
                    key, held = at, []
                held.append((row, hashes))
        if len(held) > 1:
            yield edges(held)

    return dealt.mapInArrow(compare, "u long, v long")


def _classes(docs: DataFrame, least: float, shingle: int, tile_bytes: int, tile_rows: int, id_col: str, text_col: str, carry: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored tables (row, doc), ``doc`` holding the columns in ``carry``, and (row, doc_id, mark, size, print, keys); and (mark, kept),
    the first row (by id, null ids last) of the component that a set's mark belongs to."""
    if least < 0.8:
        raise ValueError("candidates are drawn for similarities of 0.8 and more; below that, links would be lost")
    rows = stored(docs.select(F.struct(*carry).alias("doc")).withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = rows.select("row", F.col("doc").getField(id_col).alias("doc_id"), F.coalesce(F.col("doc").getField(text_col), F.lit("")).alias("text"))
    schema = T.StructType([*texts.schema[:2], *T._parse_datatype_string("mark long, size int, print array<long>, keys array<int>")])
    out, places = arrow_type(schema), blocks(rows.count(), tile_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest as digest

        for batch in text_batches(batches, 2):
            marks, sizes, prints = [], [], np.zeros((batch.num_rows, BITS // 64), np.uint64)
            for i, text in enumerate(batch.column(2).to_pylist()):
                own = shingles(text, shingle)
                marks.append(digest(own.tobytes()))
                sizes.append(len(own))
                prints[i] = fingerprint(own)
            lists = [np.ascontiguousarray(prints[:, :WORDS]).view(np.int64), keys(prints, places)]
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), t.type.value_type)).cast(t.type) for x, t in zip(lists, list(out)[4:], strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.array(marks, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), *lists], schema=out)

    found = stored(texts.mapInArrow(run, schema), "prints")
    distinct = stored(found.groupBy("mark").agg(F.min("row").alias("row"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")), "distinct-shingles")
    first = found.filter("size > 0").select("row", "size", "print", "keys").join(distinct.select("row"), "row")
    roots = components(links(first, texts.select("row", "text"), least, shingle, tile_bytes, tile_rows))
    classes = distinct.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    kept = stored(classes.groupBy("root").agg(F.min("first").alias("kept")), "components")  # stored, so a hot root's rows can be split
    return rows, found, classes.join(kept, "root").select("mark", "kept")


def near_copies(docs: DataFrame, *, least: float = 0.8, shingle: int = 5, tile_bytes: int = TILE_BYTES, tile_rows: int = TILE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component_id): the least id reachable over links."""
    _, found, classes = _classes(docs, least, shingle, tile_bytes, tile_rows, id_col, text_col, [id_col, text_col])
    return found.select("doc_id", "mark").join(classes, "mark").select("doc_id", F.col("kept.doc_id").alias("component_id"))


def first_copies(docs: DataFrame, *, least: float = 0.8, shingle: int = 5, tile_bytes: int = TILE_BYTES, tile_rows: int = TILE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of the least id, null ids last; of rows equal in id, any one.

    Rows go by a number of their own, so repeated rows, rows without an id and rows that share one are told apart.
    """
    rows, found, classes = _classes(docs, least, shingle, tile_bytes, tile_rows, id_col, text_col, docs.columns)
    copies = found.select("row", "mark").join(classes, "mark").filter("row != kept.row").select("row")
    return rows.join(copies.hint("merge"), "row", "left_anti").select("doc.*")  # one plan at every size
