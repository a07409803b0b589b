"""Near-duplicates by 64-bit SimHash and exact tiled comparison.

A text's lower-cased (A-Z) words give shingles; a fingerprint bit is set if it is set in more than half of the shingles'
XXH64 hashes. Equal fingerprints are merged first, so copies cost one row. Distinct fingerprints are compared exactly with
numpy: exclusive-or and bit counts over tiles sorted by population count, where a pair of tiles whose population counts
differ by more than the radius is skipped.

Which tiles meet: two fingerprints that differ in at most ``radius`` bits agree on at least ``keep`` of ``radius + keep``
blocks of bits, so each fingerprint joins one group per choice of ``keep`` blocks, and only groups are tiled. That loses
no link; the more fingerprints there are, the more blocks have to agree. A group of more than ``tile_rows`` is dealt by a hash into salts, and every two salts meet in a group of their own.
A tile pair yields a forest of its links, not all pairs; components then follow from all forests.

Defined results: null and empty texts have fingerprint zero, which links like any other; repeated rows fall together;
a null id belongs to its component but is never its id unless all are null; an empty table gives no rows; texts are read
whole, whatever their length; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_lists, stored
from .components import components

TILE = 512


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """As an unsigned 64-bit integer."""
    from xxhash import xxh64_intdigest as digest

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    ends = ends[min(shingle, len(words)) - 1 :].tolist()
    set_bits = np.zeros(64, np.int64)
    for a in range(0, len(ends), 1 << 16):
        some = ends[a : a + (1 << 16)]
        hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts[a:], some, strict=False)], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(ends), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, *, shingle: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def make():
        def apply(keys, texts):
            return [keys, [x - (1 << 64) if x >> 63 else x for x in (fingerprint(t, shingle, seed) for t in texts)]]

        return apply

    return map_lists(id_and_text(docs, id_col, text_col), "doc_id long, fp long", make)


def _masks(radius: int, keep: int) -> list[int]:
    """Per choice of ``keep`` blocks the signed mask of their bits."""
    edges = np.linspace(0, 64, radius + keep + 1).round().astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(blocks, keep))]


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by least index; ``parent`` stays flat."""
    while True:
        ra, rb = parent[a], parent[b]
        new = ra != rb
        if not new.any():
            return
        a, b, ra, rb = a[new], b[new], ra[new], rb[new]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while (flat := parent[parent]).tobytes() != parent.tobytes():
            parent[:] = flat


def tiled_forest(fps: np.ndarray, radius: int) -> np.ndarray:
    """Per fingerprint the index of the least it is linked to, directly or through others; all tile pairs are compared.

    A fingerprint is a 64-bit integer, or a row of up to three.
    """
    fps = fps.astype(np.uint64).reshape(len(fps), -1)
    counts = np.bitwise_count(fps).sum(1, dtype=np.int64)
    order = np.argsort(counts, kind="stable")
    fps, counts = np.ascontiguousarray(fps[order].T), counts[order]
    parent = np.arange(len(order))
    for i in range(0, len(order), TILE):
        own, top = fps[:, i : i + TILE, None], counts[min(i + TILE, len(order)) - 1]
        for j in range(i, len(order), TILE):
            if counts[j] - top > radius:
                break  # tiles are sorted: all later ones differ more
            apart = np.bitwise_count(own[0] ^ fps[0, None, j : j + TILE])
            for x, y in zip(own[1:], fps[1:, None, j : j + TILE], strict=True):
                apart += np.bitwise_count(x ^ y)
            a, b = np.divmod(np.flatnonzero(apart <= radius), apart.shape[1])
            near = (a + i) < (b + j)
            if near.any():
                _join(parent, a[near] + i, b[near] + j)
    back = np.empty_like(order)
    back[order] = order[parent]
    return back


def links(distinct: DataFrame, radius: int, keep: int = 1, tile_rows: int = 1024) -> DataFrame:
    """Edges (u, v) that connect what is linked; ``distinct`` holds each ``fp`` once."""
    masks = F.array(*map(F.lit, _masks(radius, keep)))
    rows = distinct.select("fp", F.posexplode(masks).alias("block", "mask")).select("fp", "block", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
    hot = rows.groupBy("block", "part").count().filter(F.col("count") > tile_rows).select("block", "part", F.ceil(F.col("count") / tile_rows).cast("int").alias("salts"))
    rows = rows.join(hot, ["block", "part"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    rows = rows.withColumn("own", F.expr("CAST(pmod(xxhash64(fp, block), salts) AS INT)"))
    rows = rows.withColumn("other", F.explode(F.expr("IF(salts = 1, array(0), filter(sequence(0, salts - 1), x -> x != own))")))
    rows = rows.select("block", "part", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    dealt = rows.repartition("block", "part", "lo", "hi").sortWithinPartitions("block", "part", "lo", "hi", F.bit_count("fp"), "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def edges(table: pa.Table, last: bool):
            columns = [table.column(i).to_numpy() for i in range(4)]
            fps = table.column(4).to_numpy().view(np.uint64)
            new = np.zeros(len(fps), bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), *([len(fps)] if last else [])]
            us, vs = [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b - a > 1:
                    run = fps[a:b]
                    root = tiled_forest(run, radius)
                    child = np.flatnonzero(root != np.arange(len(run)))
                    us.append(run[child])
                    vs.append(run[root[child]])
            made = pa.record_batch([np.concatenate([*x, np.empty(0, np.uint64)]).view(np.int64) for x in (us, vs)], names=["u", "v"])
            return made, table.slice(cuts[-1])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            made, held = edges(held, last=False)
            if made.num_rows:
                yield made
        if held is not None and held.num_rows:
            yield edges(held, last=True)[0]

    return dealt.mapInArrow(compare, "u long, v long")


def blocks_kept(distinct: int, radius: int, tile_rows: int = 1024) -> int:
    """So many blocks that a group of fingerprints that agree on them holds about a tile's rows, were they random."""
    keep = 1
    while keep < 4 and distinct > tile_rows << (64 * keep // (radius + keep)):
        keep += 1
    return keep


def near_duplicates(docs: DataFrame, *, radius: int = 4, shingle: int = 4, seed: int = 42, keep: int | None = None, tile_rows: int = 1024, **columns) -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 hex digits, and the least id reachable over links."""
    fps = stored(fingerprints(docs, shingle=shingle, seed=seed, **columns), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(distinct, radius, keep or blocks_kept(distinct.count(), radius, tile_rows), tile_rows))
    classes = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = stored(classes.groupBy("root").agg(F.min("first").alias("component_id")), "components")  # stored, so a hot root's rows can be split
    classes = classes.join(least, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
