"""Transformations of places, one after the other, and points moved by them in one pass.

Each is a function of places (3, n) in the order z, y, x, so that the same object moves
the points of a table, the voxels of an image and the samples of a registration.  It
travels to the tasks as it is; a field of control points may be as large as ``MOST``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxatlas.operators.splines import slopes, weights

AXES = ("z", "y", "x")
#: Numbers of a field of control points at most (64 MB), as it is sent to every task.
MOST = 8_000_000


@dataclass(frozen=True, eq=False)
class Affine:
    """matrix (p - centre) + centre + offset."""

    matrix: np.ndarray
    offset: np.ndarray
    centre: np.ndarray

    @classmethod
    def identity(cls, centre=(0.0, 0.0, 0.0)) -> Affine:
        return cls(np.eye(3), np.zeros(3), np.array(centre, float))

    def __call__(self, places: np.ndarray) -> np.ndarray:
        return self.matrix @ (places - self.centre[:, None]) + (self.centre + self.offset)[:, None]

    def inverse(self) -> Affine:
        back = np.linalg.inv(self.matrix)
        return Affine(back, -back @ self.offset, self.centre)


@dataclass(frozen=True, eq=False)
class BSplineField:
    """Places moved by a cubic B-spline field: ``grid`` (z, y, x, 3) has the displacement of each
    control point, which lie at origin + index * spacing.  A place without all of its 64
    control points stays.
    """

    grid: np.ndarray
    origin: np.ndarray
    spacing: np.ndarray

    def __post_init__(self):
        if self.grid.size > MOST:
            raise ValueError(f"a field of {self.grid.size} numbers is larger than {MOST}; use a wider spacing")

    def around(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First control points (3, n), weights (4, 3, n) and which places have all of theirs."""
        at = (places - self.origin[:, None]) / self.spacing[:, None]
        first = np.floor(at).astype(np.int64) - 1
        held = np.all((first >= 0) & (first + 3 < np.array(self.grid.shape[:3])[:, None]), axis=0)
        return first, weights(at - np.floor(at)), held

    def __call__(self, places: np.ndarray) -> np.ndarray:
        first, w, held = self.around(places)
        first, w = first[:, held], w[:, :, held]
        moved = np.zeros((3, first.shape[1]))
        for i, j, k in product(range(4), repeat=3):
            moved += self.grid[first[0] + i, first[1] + j, first[2] + k].T * (w[i, 0] * w[j, 1] * w[k, 2])
        out = places.astype(float, copy=True)
        out[:, held] += moved
        return out

    def refined(self) -> BSplineField:
        """The same field with control points at half the spacing."""
        grid = self.grid
        for axis in range(3):
            g = np.moveaxis(grid, axis, 0)
            n = len(g)
            new = np.empty((2 * n - 1, *g.shape[1:]))
            padded = np.concatenate([g[:1], g, g[-1:]])
            new[::2] = (padded[:-2] + 6 * padded[1:-1] + padded[2:]) / 8
            new[1::2] = (g[:-1] + g[1:]) / 2
            grid = np.moveaxis(new, 0, axis)
        return BSplineField(grid, self.origin, self.spacing / 2)

    @classmethod
    def still(cls, sizes, spacing) -> BSplineField:
        """A field over a volume that moves nothing, with all control points of every voxel."""
        spacing = np.array(spacing, float)
        counts = [int(np.floor((n - 1) / s)) + 4 for n, s in zip(sizes, spacing, strict=True)]
        return cls(np.zeros((*counts, 3)), -spacing, spacing)

    def slope(self, places: np.ndarray) -> np.ndarray:
        """(3, 3, n): how each moved axis changes with each axis of the place."""
        first, w, held = self.around(places)
        at = (places - self.origin[:, None]) / self.spacing[:, None]
        d = slopes(at - np.floor(at)) / self.spacing[:, None]
        out = np.repeat(np.eye(3)[:, :, None], places.shape[1], axis=2)
        first, w, d = first[:, held], w[:, :, held], d[:, :, held]
        for i, j, k in product(range(4), repeat=3):
            g = self.grid[first[0] + i, first[1] + j, first[2] + k].T
            for axis in range(3):
                factors = [(d if a == axis else w)[o, a] for a, o in enumerate((i, j, k))]
                out[:, axis, held] += g * (factors[0] * factors[1] * factors[2])
        return out


@dataclass(frozen=True, eq=False)
class Chain:
    """Transformations applied one after the other, the first one first."""

    steps: tuple

    def __call__(self, places: np.ndarray) -> np.ndarray:
        for step in self.steps:
            places = step(places)
        return places


def move_points(points: DataFrame, move) -> DataFrame:
    """``points`` with z, y and x (double) moved, and their other columns as they are; null places stay null."""
    kinds = dict(points.dtypes)
    plain = points.toDF(*(f"_{k}" for k in range(len(points.columns))))
    at = [points.columns.index(a) for a in AXES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            given = [columns[k].cast(pa.float64()) for k in at]
            known = ~np.any([c.is_null().to_numpy(zero_copy_only=False) for c in given], axis=0)
            places = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in given])
            places[:, known] = move(places[:, known])
            for k, c, p in zip(at, given, places, strict=True):
                columns[k] = pa.array(p, mask=c.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    schema = ", ".join(f"_{k} {'double' if c in AXES else kinds[c]}" for k, c in enumerate(points.columns))
    return plain.mapInArrow(run, schema).toDF(*points.columns)
