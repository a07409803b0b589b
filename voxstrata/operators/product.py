"""Label transfer to source records, merged products, and checks of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxstrata.operators import nearest


def transfer(dense: DataFrame, coarse: DataFrame, limit2: int, keys: tuple[str, ...] = ("pid",), **options) -> DataFrame:
    """Dense rows with ``label``, ``label_sem`` and ``d2`` of the nearest coarse row; null where none is in reach."""
    best = nearest.nearest(dense.select(*keys, *(c for c in ("X", "Y", "Z") if c not in keys)), coarse, limit2, keys, **options)
    return dense.join(best.select(*keys, F.col("b_inst").alias("label"), F.col("b_sem").alias("label_sem"), "d2"), list(keys), "left")


def tree_preferred(dense: DataFrame, coarse: DataFrame, limit2: int, keys: tuple[str, ...] = ("pid",)) -> DataFrame:
    """As ``transfer``, but any tree in reach goes before background."""
    return transfer(dense, coarse, limit2, keys, first=((F.col("b_inst") == 0).cast("int"),))


def require_covered(transferred: DataFrame, label: str = "label") -> DataFrame:
    """The rows, failing on the first that has no match."""
    gate = F.when(F.col(label).isNull(), F.raise_error(F.lit("a record has no match in reach")).cast("long")).otherwise(F.col(label))
    return transferred.withColumn(label, gate)


def remap(originals: DataFrame, models: dict[str, tuple[DataFrame, int, bool]], keys: tuple[str, ...] = ("file", "pid")) -> DataFrame:
    """Originals with one label column per model; a model that may miss (third value) gives 0 there, others null."""
    out = originals
    for name, (coarse, limit2, may_miss) in models.items():
        best = nearest.nearest(originals.select(*keys, "X", "Y", "Z"), coarse, limit2, keys).select(*keys, F.col("b_inst").alias(name))
        out = out.join(best, list(keys), "left")
        if may_miss:
            out = out.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def positional_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], same: tuple[str, ...]) -> DataFrame:
    """Versions of one table by record number; columns in ``same`` must be equal, and no record may lack its partner."""
    renamed = right.select(*keys, *(F.col(c).alias(f"_r_{c}") for c in right.columns if c not in keys)).withColumn("_right", F.lit(True))
    both = left.withColumn("_left", F.lit(True)).join(renamed, list(keys), "full")
    wrong = F.col("_left").isNull() | F.col("_right").isNull()
    for c in same:
        wrong = wrong | ~F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    new = [c for c in right.columns if c not in keys and c not in left.columns]
    gate = F.when(wrong, F.raise_error(F.lit("versions differ")).cast("boolean")).otherwise(F.lit(True))
    return both.withColumn("_ok", gate).filter("_ok").select(*left.columns, *(F.col(f"_r_{c}").alias(c) for c in new))


def multiset_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows whose numbers differ, with the surplus in ``a`` (negative: in ``b``); none: the tables are equal."""
    names = a.columns
    both = a.withColumn("_s", F.lit(1)).unionByName(b.select(*names).withColumn("_s", F.lit(-1)))
    return both.groupBy(*names).agg(F.sum("_s").alias("surplus")).filter("surplus != 0")


def record_index(points: DataFrame, file: str = "file", order: str = "pid") -> DataFrame:
    """``record`` over all files in (file, record) order: each file's offset is the number of rows of files before it."""
    counts = points.groupBy(file).agg(F.count("*").alias("_n"))
    before = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = counts.select(file, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(file).orderBy(order)) - 1
    return points.withColumn("_i", inside).join(offsets, file).withColumn("record", F.col("_offset") + F.col("_i")).drop("_i", "_offset")


def union_common(frames: list[DataFrame], fill: Column | None = None) -> DataFrame:
    """All rows of all frames over the union of their columns; a column that a frame lacks is 0 there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    every = [set(f.columns) for f in frames]
    partial = [c for c in out.columns if not all(c in e for e in every)]
    return out.withColumns({c: F.coalesce(c, F.lit(0) if fill is None else fill) for c in partial})


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    return [c for c in a.columns if c in b.columns]


def key_symdiff(a: DataFrame, b: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys that only one side has."""
    x, y = a.select(*keys).distinct(), b.select(*keys).distinct()
    return x.exceptAll(y).withColumn("side", F.lit("left")).unionByName(y.exceptAll(x).withColumn("side", F.lit("right")))


def id_sets_equal(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    d = key_symdiff(a, b, (key,))
    return d.agg(F.count_if(F.col("side") == "left").alias("only_left"), F.count_if(F.col("side") == "right").alias("only_right")).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def entities_once(rows: DataFrame, entity: str, source: str) -> DataFrame:
    """Each entity from its first source only."""
    first = F.min(source).over(Window.partitionBy(entity))
    return rows.withColumn("_first", first).filter(F.col(source) == F.col("_first")).drop("_first")


def lossless(rows: DataFrame, column: str, to: str) -> DataFrame:
    """One row: how many values a cast would change or lose."""
    c = F.col(column)
    cast = c.try_cast(to)
    return rows.agg(F.count("*").alias("total"), F.count_if(c.isNotNull() & (cast.isNull() | (cast.cast("double") != c.cast("double")))).alias("lost"))


def run_starts(rows: DataFrame, partition: str, order: str, value: str) -> DataFrame:
    """Where a new run of equal values begins, and the number of the run."""
    w = Window.partitionBy(partition).orderBy(order)
    new = F.coalesce((F.lag(value).over(w) != F.col(value)).cast("int"), F.lit(1))
    return rows.withColumn("starts", new).withColumn("run", F.sum("starts").over(w))


def top_examples(rows: DataFrame, by: list[Column], n: int) -> DataFrame:
    return rows.orderBy(*by).limit(n)


def sink_order(rows: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Rows in global order for a sink: ranges over partitions, sorted inside."""
    return rows.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)


def vector_components(rows: DataFrame, column: str, n: int) -> DataFrame:
    """One column per element of a fixed-length array."""
    return rows.select("*", *(F.get(column, F.lit(i)).alias(f"{column}__{i}") for i in range(n))).drop(column)


def rebuilt_vector(rows: DataFrame, column: str, n: int) -> DataFrame:
    parts = [f"{column}__{i}" for i in range(n)]
    return rows.withColumn(column, F.array(*parts)).drop(*parts)
