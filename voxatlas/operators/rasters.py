"""Points into volumes: points, heat maps and painted regions.

Results are sparse voxel tables (z, y, x, v), zeros left out; ``dense`` fills them in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.functions.scalar import round_half_even
from voxatlas.operators.cells import in_bounds

AXES = ("z", "y", "x")
Shape = tuple[int, int, int]


def ball(radius: int, strict: bool) -> list[tuple[int, int, int]]:
    """Offsets within the radius; strictly within, or on it too."""
    span = range(-radius, radius + 1)
    limit = radius * radius - (1 if strict else 0)
    return [(z, y, x) for z in span for y in span for x in span if z * z + y * y + x * x <= limit]


def _rounded(points: DataFrame) -> DataFrame:
    return points.select(*(round_half_even(a).alias(a) for a in AXES))


def _offsets(radius: int, strict: bool):
    return F.explode(F.array(*(F.struct(*(F.lit(d).alias(a) for d, a in zip(o, AXES, strict=True))) for o in ball(radius, strict)))).alias("_o")


def points_distinct(points: DataFrame, shape: Shape) -> DataFrame:
    """1 at each voxel with a point; points on one voxel count once."""
    return _rounded(points).where(in_bounds(shape)).distinct().withColumn("v", F.lit(1))


def points_count(points: DataFrame, shape: Shape) -> DataFrame:
    """The number of points on each voxel."""
    return _rounded(points).where(in_bounds(shape)).groupBy(*AXES).agg(F.count("*").alias("v"))


def heatmap_strict(points: DataFrame, shape: Shape, radius: int) -> DataFrame:
    """Balls strictly within the radius, shifted before rounding; equal voxels at one offset count once."""
    shifted = points.select(*AXES, _offsets(radius, True))
    at = shifted.select(*(round_half_even(F.col(a) + F.col(f"_o.{a}")).alias(a) for a in AXES), "_o").where(in_bounds(shape))
    return at.distinct().groupBy(*AXES).agg(F.count("*").alias("v"))


def heatmap_inclusive(points: DataFrame, shape: Shape, radius: int) -> DataFrame:
    """Balls of the whole radius around rounded points, every point counted.

    Points on one voxel are counted before the balls are laid, so that a crowded voxel
    costs one ball.
    """
    near = [(F.col(a) > -radius) & (F.col(a) < n + radius) for a, n in zip(AXES, shape, strict=True)]
    centres = _rounded(points).where(near[0] & near[1] & near[2]).groupBy(*AXES).agg(F.count("*").alias("_n"))
    laid = centres.select(*AXES, "_n", _offsets(radius, False)).select(*((F.col(a) + F.col(f"_o.{a}")).alias(a) for a in AXES), "_n")
    return laid.where(in_bounds(shape)).groupBy(*AXES).agg(F.sum("_n").alias("v"))


def paint_regions(points: DataFrame, shape: Shape, order: str = "cell_id") -> DataFrame:
    """The region id of the last point on each voxel."""
    at = points.select(*(round_half_even(a).alias(a) for a in AXES), "id", order).where(in_bounds(shape))
    return at.groupBy(*AXES).agg(F.max_by("id", order).alias("id"))


def dense(voxels: DataFrame, shape: Shape) -> DataFrame:
    """Every voxel of the volume, 0 where there was none."""
    z, y, x = shape
    grid = voxels.sparkSession.range(z * y * x).select(F.expr(f"cast(id div {y * x} as int)").alias("z"), F.expr(f"cast(id div {x} % {y} as int)").alias("y"), F.expr(f"cast(id % {x} as int)").alias("x"))
    return grid.join(voxels, list(AXES), "left").withColumn("v", F.coalesce("v", F.lit(0)))
