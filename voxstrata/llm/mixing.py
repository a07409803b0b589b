"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in an order shuffled by a hash, repeated ``epochs`` times. A document's virtual
finish time is the number of its source's words up to its end divided by the source's target; all queues are merged by
finish time, and the merged order is cut where the total budget ends. Targets are budget times weight; a target stops at
``epochs`` times its source's size, and the excess is shared again by weight (water filling, in one pass over the sources
ordered by size per weight).

No queue is summed in one place: a source's words are summed in 4096 hash ranges, and a document's place is its range's
offset plus its place in the range. The cut is found from a histogram of finish times; only the one cell in which the
budget ends is ordered (``2 ** -16`` of a unit of virtual time).

Defined results: null text has no words; a null source is a source of its own, last in code point order; documents
without words are never taken; rows of equal id are ordered by their texts' checksums; rows equal in all that are taken
together; an empty table gives no rows; other columns are ignored. Ids and seed alone decide the order, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
CELLS = 1 << 16


def weighted_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, epochs: int) -> DataFrame:
    """Add ``target`` to (source, source_size): one row per source; weights repeat over the sources' order."""
    listed = F.array(*map(F.lit, weights))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rows = sizes.withColumn("weight", F.element_at(listed, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("most", F.col("source_size") * epochs).withColumn("ratio", F.col("most") / F.col("weight"))
    rows = rows.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share))
    level = (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("level", level).withColumn("full", F.col("most") <= F.col("weight") * F.col("level"))
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return rows.withColumn("target", F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * shared)).select("source", "source_size", "target", "budget")


def mixed(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, epochs: int = 2, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target, ``taken`` words and ``times`` it is taken."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("mark"))
    rows = stored(rows, "mix-sizes")
    rows = rows.withColumn("turn", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    rows = rows.withColumn("queue", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).withColumn("part", F.substring("turn", 1, 3))
    parts = stored(rows.groupBy("source", "queue", "part").agg(F.sum("size").alias("words")), "mix-parts")
    targets = weighted_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    targets = targets.withColumn("queue", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))).drop("source")
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("queue", "part", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset")).join(targets, "queue")
    order = Window.partitionBy("queue", "part").orderBy("turn", "doc_id", "mark", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("inside", F.sum("size").over(order)).join(offsets, ["queue", "part"]).withColumn("served", F.col("offset") + F.col("inside"))
    finish = [F.when(F.col("size") > 0, (F.col("served") + F.col("source_size") * e) / F.col("target")) for e in range(epochs)]
    rows = stored(rows.select("doc_id", "queue", "turn", "mark", "size", "source_size", "target", "budget", *(f.alias(f"finish{e}") for e, f in enumerate(finish))), "mix-queue")
    entry = lambda e: rows.select(F.col(f"finish{e}").alias("finish"), "queue", "turn", "mark", "size", "budget").filter("finish IS NOT NULL")
    entries = entry(0)
    for e in range(1, epochs):
        entries = entries.unionByName(entry(e))
    entries = entries.withColumn("cell", F.least(F.floor(F.col("finish") * CELLS), F.lit(2 * CELLS)))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)  # at most 2 * CELLS + 1 rows
    cells = entries.groupBy("cell").agg(F.sum("size").alias("words"), F.first("budget").alias("budget")).withColumn("upto", F.sum("words").over(upto))
    edge = cells.filter("upto > budget").orderBy("cell").limit(1).collect()
    taken = [F.col(f"finish{e}").isNotNull() for e in range(epochs)]
    if edge:
        cell, left = edge[0]["cell"], edge[0]["budget"] - (edge[0]["upto"] - edge[0]["words"])
        merged = Window.orderBy("finish", "queue", "turn", "mark").rowsBetween(Window.unboundedPreceding, 0)
        last = entries.filter(F.col("cell") == cell).withColumn("upto", F.sum("size").over(merged)).filter(F.col("upto") <= left).orderBy(*(F.desc(c) for c in ("finish", "queue", "turn", "mark"))).limit(1).collect()
        names = ("finish", "queue", "turn", "mark")
        for e in range(epochs):
            here = F.least(F.floor(F.col(f"finish{e}") * CELLS), F.lit(2 * CELLS))
            own = F.struct(F.col(f"finish{e}").alias("finish"), "queue", "turn", "mark")
            among = own <= F.struct(*(F.lit(last[0][c]).alias(c) for c in names)) if last else F.lit(False)
            taken[e] = taken[e] & ((here < cell) | ((here == cell) & among))
    times = sum((t.cast("int") for t in taken), F.lit(0))
    return rows.withColumn("times", F.coalesce(times, F.lit(0))).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "mark")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS turn,
    coalesce('s' || source, 'n') AS queue FROM documents),
s AS (SELECT source, queue, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS most FROM s),
r AS (SELECT *, most / weight AS ratio, 1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM w),
l AS (SELECT *, (budget - CAST(coalesce(sum(most) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level FROM r),
t AS (SELECT queue, source_size, budget, CASE WHEN most <= weight * level THEN CAST(most AS DOUBLE) ELSE weight * max(CASE WHEN most > weight * level THEN level END) OVER () END AS target FROM l),
q AS (SELECT d.doc_id, d.size, t.*, d.turn, CAST(sum(d.size) OVER (PARTITION BY d.queue ORDER BY d.turn, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS served FROM d JOIN t USING (queue)),
e AS (SELECT *, CAST(served + source_size * k AS DOUBLE) / target AS finish FROM q, (VALUES (0), (1)) AS v(k) WHERE size > 0),
m AS (SELECT *, sum(size) OVER (ORDER BY finish, queue, turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM e),
n AS (SELECT doc_id, CAST(count(*) AS INTEGER) AS times FROM m WHERE upto <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(n.times, 0) AS taken, coalesce(n.times, 0) AS times FROM q LEFT JOIN n USING (doc_id)
"""
