"""Ranks and places in sorted order with DataFrame functions alone: bounded boundary lists in place of a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Boundary lists hold at most so many values.
MOST_BOUNDS = 4096


def bounds(df: DataFrame, columns: dict[str, int], accuracy: int = 10_000) -> dict[str, list[int]]:
    """Per long column so many approximate quantiles, ascending: one mergeable aggregate, one row to the driver."""
    wanted = {c: min(n, MOST_BOUNDS) for c, n in columns.items()}
    shares = {c: [i / (n + 1) for i in range(1, n + 1)] for c, n in wanted.items()}
    row = df.agg(*(F.percentile_approx(c, [*shares[c], 1.0], accuracy).alias(c) for c in wanted)).first()
    return {c: sorted(set(row[c][:-1])) if row[c] else [] for c in wanted}


def below(value: str, ascending: list[int]) -> Column:
    """How many of the boundaries are less than ``value`` (an SQL expression), by binary search; null counts as lowest."""
    if not ascending:
        return F.lit(0)
    steps, n = len(ascending).bit_length(), len(ascending)
    listed = "array(" + ",".join(f"{x}L" if x > -(1 << 63) else "(-9223372036854775807L - 1L)" for x in ascending) + ")"
    step = f"CAST(shiftleft(1, {steps} - s) AS INT)"
    return F.expr(f"coalesce(aggregate(sequence(1, {steps}), 0, (at, s) -> CASE WHEN at + {step} <= {n} AND element_at({listed}, least(at + {step}, {n})) < ({value}) THEN at + {step} ELSE at END), 0)")
