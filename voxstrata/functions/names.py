"""Names of files, tiles and outputs; listings and pairings as joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stem(path: str | Column) -> Column:
    """The last part of a path without its last extension."""
    base = F.regexp_extract(F.col(path) if isinstance(path, str) else path, r"([^/]*)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def resolution_label(metres: Column) -> Column:
    """'10cm' for whole centimetres, else millimetres; 0 is 'original'."""
    mm = F.rint(metres * 1000).cast("long")
    return F.when(mm == 0, "original").when(mm % 10 == 0, F.concat((mm / 10).cast("long").cast("string"), F.lit("cm"))).otherwise(F.concat(mm.cast("string"), F.lit("mm")))


def tile_label(col: Column, row: Column) -> Column:
    return F.format_string("c%02d_r%02d", col.cast("int"), row.cast("int"))


def tile_key(name: str | Column) -> Column:
    """The tile a name speaks of, in small letters; empty if none."""
    return F.regexp_extract(F.lower(F.col(name) if isinstance(name, str) else name), r"(c\d+_r\d+)", 1)


def short_name(name: str | Column, most: int = 32) -> Column:
    """Names of more than ``most`` bytes are cut and marked with eight digits of their digest."""
    c = F.col(name) if isinstance(name, str) else name
    cut = F.concat(F.substring(c, 1, most - 9), F.lit("_"), F.substring(F.sha2(c, 256), 1, 8))
    return F.when(F.octet_length(c) <= most, c).otherwise(cut)


def stable_order(rows: DataFrame, name: str = "name") -> DataFrame:
    """``tile`` numbers files from 0 by name without regard to case: one row a file."""
    return rows.withColumn("tile", (F.row_number().over(Window.orderBy(F.lower(name), name)) - 1).cast("long"))


def _copc(name: str) -> Column:
    return F.lower(name).rlike(r"\.copc\.la[sz]$")


def source_key(name: str) -> Column:
    return F.regexp_replace(F.lower(name), r"(\.copc)?\.la[sz]$", "")


def preferred_inputs(files: DataFrame, name: str = "name") -> DataFrame:
    """One file per key: the cloud-optimised twin goes before the plain one; two of a kind are an error."""
    keyed = files.filter(F.lower(name).rlike(r"\.la[sz]$")).withColumn("_key", source_key(name)).withColumn("_copc", _copc(name))
    clash = F.count("*").over(Window.partitionBy("_key", "_copc")) > 1
    gate = F.when(clash, F.raise_error(F.lit("two inputs of one name")).cast("boolean")).otherwise(F.lit(True))
    best = Window.partitionBy("_key").orderBy(F.desc("_copc"))
    ranked = keyed.withColumn("_rank", F.row_number().over(best)).withColumn("_ok", gate)
    return ranked.filter("_ok AND _rank = 1").drop("_key", "_copc", "_rank", "_ok")


def raw_inputs(files: DataFrame, name: str = "name") -> DataFrame:
    return files.filter(F.lower(name).rlike(r"\.la[sz]$") & ~_copc(name))


def copc_inputs(files: DataFrame, name: str = "name", *, only: bool = False) -> DataFrame:
    """Cloud-optimised inputs; ``only``: those without a plain twin."""
    found = files.filter(_copc(name))
    if not only:
        return found
    twins = raw_inputs(files, name).select(source_key(name).alias("_key"))
    return found.withColumn("_key", source_key(name)).join(twins, "_key", "left_anti").drop("_key")


def paired(source: DataFrame, target: DataFrame, key: str, *, strict: bool = True) -> DataFrame:
    """Source tiles with their target; with ``strict`` a source without one is an error."""
    out = source.join(target.withColumn("_hit", F.lit(True)), key, "left")
    if strict:
        gate = F.when(F.col("_hit").isNull(), F.raise_error(F.lit("a source tile has no target")).cast("boolean")).otherwise(F.lit(True))
        out = out.withColumn("_hit", gate).filter("_hit")
    return out.drop("_hit")


def sidecars(files: DataFrame, tile: str, kind: str, kinds: list[str]) -> DataFrame:
    """Per tile how many files of each kind it has, and whether it is exactly one."""
    out = files.groupBy(tile).agg(*(F.count_if(F.col(kind) == k).alias(k) for k in kinds))
    ok = F.lit(True)
    for k in kinds:
        ok = ok & (F.col(k) == 1)
    return out.withColumn("paired", ok)


def twins(raw: DataFrame, copc: DataFrame, tolerance: float) -> DataFrame:
    """Per key whether raw and cloud-optimised headers (n, lo, hi) agree."""
    b = copc.select("key", *(F.col(c).alias(f"_{c}") for c in ("n", "lo", "hi")))
    off = (F.abs(F.col("lo") - F.col("_lo")) > tolerance) | (F.abs(F.col("hi") - F.col("_hi")) > tolerance)
    status = F.when(F.col("n").isNull() | F.col("_n").isNull(), "missing").when(F.col("n") != F.col("_n"), "count").when(off, "bounds").otherwise("same")
    return raw.join(b, "key", "full").select("key", status.alias("status"))
