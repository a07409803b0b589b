"""A composable surface over the operators: a frame of points on a lattice."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from voxstrata.functions.lattice import limit2
from voxstrata.operators import grid, instances, nearest, ownership, product, reconcile, voxel


@dataclass(frozen=True)
class Lattice:
    """Scale as an exact decimal; lengths given in metres become whole lattice units."""

    scale: str = "0.001"

    def units(self, metres: str) -> int:
        from fractions import Fraction

        value = Fraction(metres) / Fraction(self.scale)
        if value.denominator != 1:
            raise ValueError(f"{metres} isn't a whole number of lattice units")
        return int(value)


@dataclass(frozen=True)
class PointFrame:
    """Points (X, Y, Z and, as operators need, tile, pid, inst, sem, file) on a lattice. Every method is lazy."""

    df: DataFrame
    lattice: Lattice = Lattice()

    def _with(self, df: DataFrame) -> PointFrame:
        return replace(self, df=df)

    def layout(self, length: str, buffer: str) -> DataFrame:
        return grid.tile_grid(self.df, self.lattice.units(length), self.lattice.units(buffer))

    def tile(self, length: str, buffer: str, resolutions: list[str]) -> DataFrame:
        """Buffered tiles, occupied cores, and a mean per voxel and resolution ('0': the points)."""
        size, around = self.lattice.units(length), self.lattice.units(buffer)
        return voxel.tile_product(self.df, grid.frame(self.df, size, around), size, around, [self.lattice.units(r) for r in resolutions])

    def assign(self, length: str, buffer: str) -> PointFrame:
        return self._with(grid.assign_buffered(self.df, self.layout(length, buffer), self.lattice.units(length), self.lattice.units(buffer)))

    def voxelize(self, resolution: str, *, keep: str = "mean", keys: tuple[str, ...] = ()) -> DataFrame:
        make = {"mean": voxel.centers, "nearest": voxel.representatives}[keep]
        return make(self.df, self.lattice.units(resolution), keys)

    def nearest(self, build: DataFrame, radius: str, keys: tuple[str, ...] = ("pid",), **options) -> DataFrame:
        return nearest.nearest(self.df, build, limit2(radius, self.lattice.scale), keys, **options)

    def covered(self, build: DataFrame, radius: str, keys: tuple[str, ...] = ("pid",)) -> PointFrame:
        return self._with(nearest.exists_within(self.df, build, limit2(radius, self.lattice.scale), keys))

    def own(self, tiles: DataFrame, anchor: str = "centroid") -> PointFrame:
        return self._with(ownership.core_filter(self.df, tiles, grid.neighbors(tiles), anchor))

    def reconcile(self, tiles: DataFrame, radius: str = "0.05", threshold: float = 0.3, least: int = 10, most_distance: str = "5", normal: DataFrame | None = None) -> PointFrame:
        """Labels of all tiles become global ones; ``normal``: the (tile, inst) that aren't recovered."""
        overlapping, far = grid.overlaps(tiles), self.lattice.units(most_distance)
        edges = reconcile.match_edges(self.df, overlapping, limit2(radius, self.lattice.scale), threshold=threshold, least=least, most_distance=far)
        mapping = reconcile.reconciled(self.df, overlapping, edges, far, normal)
        named = instances.mapped(self.df, mapping, ("tile", "inst"), "group")
        return self._with(named.drop("inst").withColumnRenamed("group", "inst"))

    def dedup(self, tiles: DataFrame, radius: str = "0.01", *, refuse: bool = True) -> PointFrame:
        """One owner a place; with ``refuse`` labels that still conflict are an error."""
        return self._with(ownership.pipeline(self.df, tiles, limit2(radius, self.lattice.scale), refuse=refuse))

    def consolidate(self, tiles: DataFrame) -> PointFrame:
        return self._with(instances.consolidate(self.df, instances.owner_plan(self.df, tiles)))

    def remap(self, models: dict[str, tuple[DataFrame, str, bool]], keys: tuple[str, ...] = ("file", "pid")) -> PointFrame:
        return self._with(product.remap(self.df, {n: (m, limit2(r, self.lattice.scale), miss) for n, (m, r, miss) in models.items()}, keys))
