"""Radius joins on the integer lattice: nearest, existence, absence.

Both sides get a grid cell key as wide as the radius; the probe side meets the 9 (XY) or 27 (XYZ) cells around its own by
an equi-join, and the exact squared distance is a residual predicate. Ties go to the least (distance, tile, pid). The
plan is a plain hash or sort-merge join: nothing is broadcast by hand, and adaptive execution splits hot cells.

Where cells of that width would hold many build rows, the nearest one is searched in rounds of growing radius instead:
cells start so small that they hold about one row, a row that finds a match within a round's radius is done (nothing
nearer can lie outside), and only the others go on with twice the radius. Equal positions are searched and met once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxstrata.functions.lattice import floor_div
from voxstrata.operators.lineage import cut

AXES = ("X", "Y", "Z")
#: Build rows in a cell, as a build row sees it on average, from which the radius grows in rounds.
CROWDED = 32


def _cells(df: DataFrame, size: int, spread: bool, axes: tuple[str, ...]) -> DataFrame:
    for a in axes:
        own = floor_div(a, size)
        df = df.withColumn(f"_c{a}", F.explode(F.array(own - 1, own, own + 1)) if spread else own)
    return df


def pairs(probe: DataFrame, build: DataFrame, limit2: int, *, on: tuple[str, ...] = (), where: Column | None = None, axes: tuple[str, ...] = AXES, cell: int | None = None) -> DataFrame:
    """All (probe, build) pairs within ``sqrt(limit2)``, inclusive: columns prefixed ``q_`` and ``b_``, and ``d2``.

    ``on``: columns that must be equal (they join the key); ``where``: more conditions over prefixed columns.
    """
    size = cell or _width(limit2)
    q = _cells(probe.select([F.col(c).alias(f"q_{c}") for c in probe.columns] + [F.col(a) for a in axes]), size, True, axes).drop(*axes)
    b = _cells(build.select([F.col(c).alias(f"b_{c}") for c in build.columns] + [F.col(a) for a in axes]), size, False, axes).drop(*axes)
    for c in on:
        q, b = q.withColumn(f"_k{c}", F.col(f"q_{c}")), b.withColumn(f"_k{c}", F.col(f"b_{c}"))
    joined = q.join(b, [f"_c{a}" for a in axes] + [f"_k{c}" for c in on])
    d2 = sum(((F.col(f"q_{a}") - F.col(f"b_{a}")) * (F.col(f"q_{a}") - F.col(f"b_{a}")) for a in axes), F.lit(0).cast("long"))
    joined = joined.withColumn("d2", d2).filter(F.col("d2") <= limit2)
    return (joined.filter(where) if where is not None else joined).drop(*(f"_c{a}" for a in axes), *(f"_k{c}" for c in on))


def _width(limit2: int) -> int:
    return max(1, int(limit2**0.5) + (int(limit2**0.5) ** 2 < limit2))


def _crowd(build: DataFrame, size: int, on: tuple[str, ...], axes: tuple[str, ...]) -> float:
    """How many build rows share a cell of width ``size`` with a build row, on average."""
    cells = build.groupBy(*(floor_div(a, size).alias(f"_c{a}") for a in axes), *on).agg(F.count("*").cast("double").alias("_n"))
    total, squares = cells.agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_n"))).first()
    return squares / total if total else 0.0


def _best(found: DataFrame, keys: tuple[str, ...], first: tuple[Column, ...]) -> DataFrame:
    names = [c for c in found.columns if c.startswith("b_")]
    tie = [F.col(c) for c in ("b_tile", "b_pid") if c in names]
    order = F.struct(*(c.alias(f"f{i}") for i, c in enumerate((*first, F.col("d2"), *tie))))
    best = found.groupBy(*(f"q_{k}" for k in keys)).agg(F.min_by(F.struct("d2", *names), order).alias("_b"))
    return best.select(*(F.col(f"q_{k}").alias(k) for k in keys), "_b.*")


def _grown(probe: DataFrame, build: DataFrame, limit2: int, keys: tuple[str, ...], on: tuple[str, ...], where: Column | None, axes: tuple[str, ...]) -> DataFrame:
    """Rounds of growing radius; with ``where`` rows of equal position stay apart, as the condition may tell them apart."""
    places, size = (*axes, *(c for c in on if c not in axes)), _width(limit2)
    asked, names = probe, keys
    if where is None:
        tie = [F.col(c) for c in ("tile", "pid") if c in build.columns] or [F.lit(0)]
        other = [c for c in build.columns if c not in places]
        build = build.groupBy(*places).agg(F.min_by(F.struct(*(other or places)), F.struct(*(c.alias(f"t{i}") for i, c in enumerate(tie)))).alias("_b"))
        build = cut(build.select(*places, *(F.col(f"_b.{c}").alias(c) for c in other)))
        asked, names = probe.select(*places).distinct(), places
    width = max(1, int(size * max(1.0, _crowd(build, size, on, axes)) ** (-1 / len(axes))))
    done = None
    while True:
        width = min(width, size)
        last = width == size
        seen = cut(_best(pairs(asked, build, limit2 if last else width * width, on=on, where=where, axes=axes, cell=width), names, ()))
        done = seen if done is None else done.unionByName(seen)
        if last:
            break
        asked = cut(asked.join(seen.select(*names), list(names), "left_anti"))
        if asked.isEmpty():
            break
        width *= 2
    if where is not None:
        return done
    back = probe.select(*dict.fromkeys((*keys, *places))).join(done, list(places))
    return back.select(*keys, "d2", *(c for c in done.columns if c.startswith("b_")))


def nearest(probe: DataFrame, build: DataFrame, limit2: int, keys: tuple[str, ...], *, first: tuple[Column, ...] = (), on: tuple[str, ...] = (), where: Column | None = None, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Per probe row (identified by ``keys``) that has a match: the nearest build row's columns (``b_``) and ``d2``.

    ``first``: what counts before the distance (prefixed columns); then the radius can't grow.
    """
    if not first and _crowd(build, _width(limit2), on, axes) > CROWDED:
        return _grown(probe, build, limit2, keys, on, where, axes)
    return _best(pairs(probe, build, limit2, on=on, where=where, axes=axes), keys, first)


def within(probe: DataFrame, build: DataFrame, limit2: int, keys: tuple[str, ...], *, on: tuple[str, ...] = (), where: Column | None = None, axes: tuple[str, ...] = AXES) -> DataFrame:
    """Keys of probe rows with any build row within reach."""
    if _crowd(build, _width(limit2), on, axes) > CROWDED:
        return _grown(probe, build, limit2, keys, on, where, axes).select(*keys).distinct()
    return pairs(probe, build, limit2, on=on, where=where, axes=axes).select(*(F.col(f"q_{k}").alias(k) for k in keys)).distinct()


def exists_within(probe: DataFrame, build: DataFrame, limit2: int, keys: tuple[str, ...], **options) -> DataFrame:
    return probe.join(within(probe, build, limit2, keys, **options), list(keys), "left_semi")


def not_exists_within(probe: DataFrame, build: DataFrame, limit2: int, keys: tuple[str, ...], **options) -> DataFrame:
    return probe.join(within(probe, build, limit2, keys, **options), list(keys), "left_anti")


def coverage(matched: DataFrame, limit2: int, by: tuple[str, ...] = ()) -> DataFrame:
    """From rows with ``d2`` or null: totals, matches, the largest distance and five bins at quarters of the radius."""
    edges = [limit2 * k * k // 16 for k in (1, 2, 3)]
    bins = [F.col("d2") == 0, *((F.col("d2") > lo) & (F.col("d2") <= hi) for lo, hi in zip([0, *edges], [*edges, limit2], strict=True))]
    out = matched.groupBy(*by) if by else matched.groupBy()
    return out.agg(F.count("*").alias("total"), F.count("d2").alias("matched"), F.max("d2").alias("max_d2"), *(F.count_if(c).alias(f"bin{i}") for i, c in enumerate(bins)))
