"""Exact arithmetic on integer lattices: expressions over BIGINT columns, without UDFs.

Coordinates are whole lattice units. Nothing here depends on row order or on the order of floating-point sums.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

INT32 = (-(1 << 31), (1 << 31) - 1)


def col(x: str | int | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def exact_div(a: Column, b: Column) -> Column:
    """``a / b`` where ``a`` is a multiple of ``b``: whole-number division, generated code for 64 bits."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def floor_div(a: str | Column, b: int | Column) -> Column:
    """Quotient rounded down, for any sign of ``a`` and positive ``b``."""
    a, b = col(a).cast("long"), col(b).cast("long")
    return exact_div(a - F.pmod(a, b), b)


def half_even(total: str | Column, n: str | Column) -> Column:
    """``total / n`` rounded once, halves to even."""
    total, n = col(total), col(n)
    rest = F.pmod(total, n)
    q = exact_div(total - rest, n)
    up = (2 * rest > n) | ((2 * rest == n) & (F.pmod(q, F.lit(2)) == 1))
    return (q + up.cast("long")).cast("long")


def voxel_ratio(scale: str, offset: str, resolution: str) -> tuple[int, int, int]:
    """(a, b, den) with ``floor((raw * scale + offset) / resolution) = floor((raw * a + b) / den)``, all exact decimals."""
    s, o, r = Fraction(scale), Fraction(offset), Fraction(resolution)
    den = math.lcm((s / r).denominator, (o / r).denominator)
    a, b = int(s / r * den), int(o / r * den)
    if max(abs(a) << 31, abs(b), den) >= 1 << 62:
        raise OverflowError("voxel keys of this lattice don't fit 64 bits")
    return a, b, den


def voxel_key(raw: str | Column, scale: str = "1", offset: str = "0", resolution: str = "1") -> Column:
    a, b, den = voxel_ratio(scale, offset, resolution)
    return floor_div(col(raw).cast("long") * F.lit(a) + F.lit(b), den)


def d2(a: str, b: str, axes: tuple[str, ...] = ("X", "Y", "Z")) -> Column:
    """Squared distance of two aliases' points."""
    return sum(((F.col(f"{a}.{x}") - F.col(f"{b}.{x}")) * (F.col(f"{a}.{x}") - F.col(f"{b}.{x}")) for x in axes), F.lit(0).cast("long"))


def limit2(radius: str, scale: str = "1") -> int:
    """Largest squared lattice distance within an inclusive radius."""
    return math.floor((Fraction(radius) / Fraction(scale)) ** 2)


def ulp_guard(largest: float, ulps: int = 8) -> float:
    """So many units in the last place at ``max(1, |largest|)``."""
    return ulps * math.ulp(max(1.0, abs(largest)))


def lattice_is_exact(scale: str, radius: str, extent: float) -> bool:
    """Whether no lattice distance but the radius itself falls into the guard around it."""
    s, r = Fraction(scale), Fraction(radius)
    return s * s / (2 * r) > Fraction(ulp_guard(extent))


def decoded(raw: str | Column, scale: str, offset: str) -> Column:
    return col(raw) * F.lit(float(Fraction(scale))) + F.lit(float(Fraction(offset)))


def encoded(value: str | Column, scale: str, offset: str) -> Column:
    """Rounded to the lattice, halves to even; what doesn't fit 32 bits is an error, never wrapped."""
    raw = F.rint((col(value) - F.lit(float(Fraction(offset)))) / F.lit(float(Fraction(scale)))).cast("long")
    return F.when(raw.between(*INT32), raw.cast("int")).otherwise(F.raise_error(F.lit("coordinate doesn't fit the lattice")).cast("int"))


def fits_int32(raw: str | Column) -> Column:
    return col(raw).between(*INT32)


def rect_distance2(x: Column, y: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Squared XY distance to a closed rectangle."""
    zero = F.lit(0).cast("long")
    dx, dy = F.greatest(x0 - x, x - x1, zero), F.greatest(y0 - y, y - y1, zero)
    return dx * dx + dy * dy


def morton3(x: str | Column, y: str | Column, z: str | Column, bits: int = 21) -> Column:
    """Interleaved bits of three non-negative values."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for k, v in enumerate((x, y, z)):
            bit = F.shiftright(col(v).cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, 3 * i + k))
    return out


def encode_rct(tile: str | Column, local: str | Column, stride: int = 100_000) -> Column:
    """``tile * stride + local`` for positive local ids, 0 for background; both parts must fit."""
    tile, local = col(tile), col(local)
    fits = (local >= 0) & (local < stride) & (tile >= 0) & (tile * stride + local < (1 << 32))
    return F.when(local == 0, F.lit(0)).when(fits, tile * stride + local).otherwise(F.raise_error(F.lit("identifier doesn't fit its namespace")).cast("long")).cast("long")


def decode_rct(value: str | Column, stride: int = 100_000) -> tuple[Column, Column]:
    return floor_div(value, stride), F.pmod(col(value), F.lit(stride)).cast("long")


def octahedral(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
    """Unit direction to the square [-1, 1]^2."""
    one = F.abs(x) + F.abs(y) + F.abs(z)
    u, v = x / one, y / one
    sign = lambda c: F.when(c >= 0, 1.0).otherwise(-1.0)
    return F.when(z >= 0, u).otherwise((1 - F.abs(v)) * sign(u)), F.when(z >= 0, v).otherwise((1 - F.abs(u)) * sign(v))


def quantized_u16(value: Column, low: Column, size: Column) -> Column:
    return F.least(F.greatest(F.rint((value - low) / size * 65535), F.lit(0.0)), F.lit(65535.0)).cast("int")


def splitmix64(index: str | Column, seed: int = 0) -> Column:
    """The splitmix64 hash of an index, as a signed long; products of 64-bit values need wrapping, so numpy does them."""

    @F.pandas_udf("long")
    def mix(s: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            # fixed values of the published generator
            z = s.to_numpy().astype("int64").view("uint64") + np.uint64(seed) + np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return pd.Series((z ^ (z >> np.uint64(31))).view("int64"))

    return mix(col(index))
