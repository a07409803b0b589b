"""Event-time forms of the aggregations: the same functions take a batch or a stream."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _late(rows: DataFrame, ts: str, late: str | None) -> DataFrame:
    return rows.withWatermark(ts, late) if late and rows.isStreaming else rows


def counts(rows: DataFrame, width: str, slide: str | None = None, *, ts: str = "ts", by: tuple[str, ...] = ("event_type",), late: str | None = "1 hour") -> DataFrame:
    """Counts in tumbling (or sliding) windows."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    return _late(rows, ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def sessions(rows: DataFrame, gap: str, *, ts: str = "ts", by: tuple[str, ...] = ("user_id",), late: str | None = "1 hour") -> DataFrame:
    """Runs of events of a key with no pause of ``gap`` or more."""
    w = F.session_window(ts, gap)
    return _late(rows, ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def running_statistics(points: DataFrame, keys: tuple[str, ...] = ("inst",)) -> DataFrame:
    """Mergeable statistics per instance; over a stream in update mode."""
    return points.groupBy(*keys).agg(F.count("*").alias("n"), F.min("X").alias("min_x"), F.max("X").alias("max_x"), F.sum("X").alias("sum_x"))


def exact_once(points: DataFrame, ts: str, late: str) -> DataFrame:
    """Points of equal lattice coordinates once; over a stream within the watermark."""
    if points.isStreaming:
        return points.withWatermark(ts, late).dropDuplicatesWithinWatermark(["X", "Y", "Z"])
    return points.dropDuplicates(["X", "Y", "Z"])


def radius_once(points: DataFrame, cell: int, limit2: int) -> DataFrame:
    """A stream's points that no survivor of the same cell lies within reach of; state holds each cell's survivors.

    Probes near a border belong to the neighbour's cell too; callers that need those replicate them first.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [tuple(x) for x in (state.get[0] if state.exists else [])]
        out = []
        for pdf in frames:
            for r in pdf.sort_values("pid").itertuples(index=False):
                if all((r.X - x) ** 2 + (r.Y - y) ** 2 + (r.Z - z) ** 2 > limit2 for x, y, z in held):
                    held.append((r.X, r.Y, r.Z))
                    out.append((r.pid, r.X, r.Y, r.Z))
        state.update(([list(map(int, x)) for x in held],))
        yield pd.DataFrame(out, columns=["pid", "X", "Y", "Z"]).astype("int64")

    keys = [F.floor(F.col(a) / cell).alias(f"c{a}") for a in "XYZ"]
    return points.select("pid", "X", "Y", "Z", *keys).groupBy("cX", "cY", "cZ").applyInPandasWithState(step, "pid long, X long, Y long, Z long", "held array<array<long>>", "append", GroupStateTimeout.NoTimeout)
