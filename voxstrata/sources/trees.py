"""Tree tables: two header lines, then rows; rows of the info table hold a variable number of segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tree_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, id, attributes): the first column is the identifier where the heading begins with one, else the row's number."""
    text = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value"))
    lines = text.withColumn("lines", F.split(F.regexp_replace("value", r"\r", ""), "\n"))
    heading = F.transform(F.split(F.element_at("lines", 2), r"\s*,\s*"), lambda c: F.lower(F.trim(c)))
    rows = lines.select("file", heading.alias("heading"), F.posexplode(F.expr("slice(lines, 3, greatest(size(lines) - 2, 0))")).alias("n", "line")).filter(F.trim("line") != "")
    parts = F.split("line", r"\s*,\s+")
    first = F.split(F.get(parts, F.lit(0)), r"\s*,\s*")
    explicit = F.get("heading", F.lit(0)).isin("predinstance", "treeid", "id", "tree_id")
    identifier = F.when(explicit, F.trim(F.get(first, F.lit(0))).try_cast("double").cast("long")).otherwise(F.col("n") + 1)
    return rows.select("file", identifier.alias("id"), "heading", parts.alias("parts"), first.alias("first"))


def segments(parts: Column, fields: tuple[str, ...]) -> Column:
    """Segment tuples as structs of doubles; ``parent_id`` as a whole number."""
    one = lambda s: F.struct(*(F.get(F.split(s, ","), F.lit(i)).try_cast("double").cast("int" if n == "parent_id" else "double").alias(n) for i, n in enumerate(fields)))
    return F.transform(F.filter(parts, lambda s: F.trim(s) != ""), one)


def tree_info(spark: SparkSession, path: str, fields: tuple[str, ...] = ("x", "y", "z", "radius", "parent_id")) -> DataFrame:
    """(file, id, attributes, segments): attributes by the heading's names, segments nested."""
    rows = tree_lines(spark, path)
    rest = F.expr("slice(parts, 2, greatest(size(parts) - 1, 0))")
    values = F.transform("first", lambda v: v.try_cast("double"))
    # the heading also names the segments' fields: it counts as far as there are attributes
    named = F.map_from_arrays(F.slice("heading", F.lit(1), F.least(F.size("heading"), F.size("first"))), F.slice(values, F.lit(1), F.least(F.size("heading"), F.size("first"))))
    return rows.select("file", "id", named.alias("attributes"), segments(rest, fields).alias("segments"))


def kept(table: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of kept identifiers under their new ones; the mapping (id, new) holds instances, not points."""
    return table.join(mapping.select("id", "new"), "id").withColumn("id", F.col("new")).drop("new")
