"""Sharding along a Hilbert curve, with DataFrame functions only.

Each metadata dimension is a long (strings: their leading bytes as a number, which keeps their order) and is quantised
into ``2 ** bits`` cells between approximate quantiles. The cells are coordinates on a Hilbert curve; rows are ordered by
curve index, then by the text's hash, so equal texts with equal metadata lie together, then by the id. Cutting that order
into runs gives shards whose value ranges are narrow in every dimension at once, so a reader prunes files by any of them.

The order is never sorted in one place: a 63-bit key of curve index, text hash and id hash is cut into buckets between
approximate quantiles, so even a group of copies with a third of the rows spreads over many; ranks in a bucket plus the
prefix sums of the buckets' counts (at most ``ranks.MOST_BOUNDS`` rows) are ranks in the whole.

Laws: ``rows`` (counts differ by one at most) or ``bytes`` (a shard ends where its share of all bytes does).

Defined results: null text has size 8 and the checksum of no bytes; null metadata lie in the lowest cell; rows that are
equal in everything get different slots; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored
from .ranks import MOST_BOUNDS, below, bounds

TEXT_BITS, ID_BITS = 25, 20


def ordinal(name: str) -> Column:
    """A string's first seven UTF-8 bytes as a number: order by code point is kept."""
    return F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(name), "utf-8"), 1, 7)), 14, "0"), 16, 10).cast("long")


def hilbert_index(df: DataFrame, cells: list[str], bits: int, to: str) -> DataFrame:
    """Add the Hilbert index of long columns in ``[0, 2 ** bits)``, by the transposed-bits construction.

    From the highest bit down, each axis either inverts or exchanges the lower bits of the first; a Gray code over the
    axes follows, and the bits are interleaved.
    """
    n, q = len(cells), f"shiftleft(1L, {bits - 1} - CAST(s DIV {len(cells)} AS INT))"
    at = f"element_at(x, CAST(s % {n} AS INT) + 1)"
    turned = f"""aggregate(sequence(0, {n * (bits - 1) - 1}), array({", ".join(f"CAST({c} AS BIGINT)" for c in cells)}), (x, s) ->
        transform(x, (v, j) -> CASE WHEN ({at} & {q}) <> 0 THEN IF(j = 0, v ^ ({q} - 1L), v)
            WHEN j = 0 OR j = s % {n} THEN IF(s % {n} = 0, v, v ^ ((element_at(x, 1) ^ {at}) & ({q} - 1L))) ELSE v END))"""
    df = df.withColumn("_x", F.expr(turned))
    df = df.withColumn("_x", F.expr("transform(_x, (v, j) -> aggregate(slice(_x, 1, j + 1), 0L, (a, b) -> a ^ b))"))
    df = df.withColumn("_t", F.expr(f"aggregate(sequence(1, {bits - 1}), 0L, (t, k) -> IF((element_at(_x, {n}) & shiftleft(1L, k)) <> 0, t ^ (shiftleft(1L, k) - 1L), t))"))
    df = df.withColumn(to, F.expr(f"aggregate(sequence(0, {n * bits - 1}), 0L, (h, s) -> h * 2L + (shiftright(element_at(_x, CAST(s % {n} AS INT) + 1) ^ _t, {bits - 1} - CAST(s DIV {n} AS INT)) & 1L))"))
    return df.drop("_x", "_t")


def hilbert_shards(docs: DataFrame, shards: int, dims: dict[str, Column], *, law: str = "rows", bits: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, size, text_crc32, curve index, shard and slot. ``dims``: long columns by name."""
    if len(dims) * bits + TEXT_BITS + ID_BITS > 63:
        raise ValueError("curve index, text hash and id hash must fit 63 bits")
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [f"dim{i}" for i in range(len(dims))]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"), *(c.cast("long").alias(n) for n, c in zip(names, dims.values(), strict=True)),
    )
    rows = stored(rows, "shard-rows")  # a few numbers a row; the texts are read once
    cut = bounds(rows, dict.fromkeys(names, 2**bits - 1))
    for n in names:
        rows = rows.withColumn(f"cell_{n}", below(n, cut[n]).cast("long"))
    rows = hilbert_index(rows, [f"cell_{n}" for n in names], bits, "curve")
    rows = rows.withColumn("key", F.expr(f"shiftleft(curve, {TEXT_BITS + ID_BITS}) | shiftleft(shiftrightunsigned(text_hash, {64 - TEXT_BITS}), {ID_BITS}) | shiftrightunsigned(xxhash64(doc_id), {64 - ID_BITS})"))
    rows = stored(rows.drop(*names), "shard-keys")
    buckets = min(MOST_BOUNDS, 4 * partitions(docs.sparkSession))
    rows = rows.withColumn("bucket", below("key", bounds(rows, {"key": buckets})["key"]))
    # at most MOST_BOUNDS + 1 rows stand in this window and are broadcast
    first = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("size").alias("b"))
    bases = bases.select("bucket", *(F.coalesce(F.sum(c).over(first), F.lit(0)).alias(f"{c}_before") for c in "nb"), *(F.sum(c).over(every).alias(f"{c}_all") for c in "nb"))
    inside = Window.partitionBy("bucket").orderBy("key", "text_hash", "doc_id", "size")
    placed = rows.withColumn("place", F.row_number().over(inside) - 1).withColumn("ahead", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(F.broadcast(bases), "bucket").withColumn("rank", F.col("n_before") + F.col("place"))
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"CAST(rank * {shards} DIV n_all AS INT)")).withColumn("slot", F.expr(f"rank - (shard * n_all + {shards - 1}) DIV {shards}"))
    elif law == "bytes":
        placed = placed.withColumn("shard", F.expr(f"CAST((b_before + ahead) * {shards} DIV b_all AS INT)"))
        starts = placed.groupBy("shard").agg(F.min("rank").alias("from_rank"))
        placed = placed.join(F.broadcast(starts), "shard").withColumn("slot", F.col("rank") - F.col("from_rank"))
    else:
        raise ValueError(f"no law {law!r}")
    return placed.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve")


def document_shards(docs: DataFrame, shards: int = 24, **options) -> DataFrame:
    """Shards of documents over source, language and size."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return hilbert_shards(docs, shards, {"source": ordinal("source"), "lang": ordinal("lang"), "size": size}, **options)
