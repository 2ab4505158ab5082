"""Points and images moved by a transformation: affine ones are projections, others are here.

A transformation of points is a function of a DataFrame that has z, y, x (double) and
other columns, which it keeps.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
Shape = tuple[int, int, int]


def _cubic(u: Column) -> list[Column]:
    """Weights of the four control points around a place, ``u`` being its part between the middle two."""
    v = F.lit(1.0) - u
    return [v * v * v / 6, (3 * u * u * u - 6 * u * u + 4) / 6, (3 * v * v * v - 6 * v * v + 4) / 6, u * u * u / 6]


def bspline(points: DataFrame, grid: DataFrame, origin: tuple[float, float, float], spacing: tuple[float, float, float], key: str = "cell_id") -> DataFrame:
    """Points moved by a cubic B-spline field.

    ``grid`` has a control point a row: gz, gy, gx (from 0) and its displacement dz, dy,
    dx; control point g lies at origin + g * spacing.  A point without all of its 64
    control points stays where it is.  ``key`` is unique.  The grid is joined, so that
    it may be of any size; the planner broadcasts it if it is small.
    """
    places = {a: (F.col(a).cast("double") - F.lit(float(o))) / F.lit(float(s)) for a, o, s in zip(AXES, origin, spacing, strict=True)}
    near = points.select(key, *(F.floor(t).cast("int").alias(f"_i{a}") for a, t in places.items()), *(F.array(*_cubic(t - F.floor(t))).alias(f"_w{a}") for a, t in places.items()))
    offsets = F.array(*(F.struct(*(F.lit(k).alias(a) for a, k in zip(AXES, o, strict=True))) for o in product(range(4), repeat=3)))
    laid = near.withColumn("_o", F.explode(offsets))
    weight = F.lit(1.0)
    for a in AXES:
        weight = weight * F.get(f"_w{a}", F.col(f"_o.{a}"))
    laid = laid.select(key, *((F.col(f"_i{a}") - 1 + F.col(f"_o.{a}")).alias(f"g{a}") for a in AXES), weight.alias("_w"))
    moved = laid.join(grid.select(*(F.col(f"g{a}").cast("int").alias(f"g{a}") for a in AXES), *(f"d{a}" for a in AXES)), [f"g{a}" for a in AXES])
    sums = moved.groupBy(key).agg(F.count("*").alias("_n"), *(F.sum(F.col("_w") * F.col(f"d{a}")).alias(f"_d{a}") for a in AXES)).where("_n = 64")
    return points.join(sums, key, "left").withColumns({a: F.col(a).cast("double") + F.coalesce(f"_d{a}", F.lit(0.0)) for a in AXES}).drop("_n", *(f"_d{a}" for a in AXES))


def warp_image(image: DataFrame, sizes: Shape, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The image seen from a space of ``sizes`` voxels: each voxel's place is transformed into
    the image and read there, linear between its eight neighbours, beyond which all is 0.
    """
    z, y, x = sizes
    grid = image.sparkSession.range(z * y * x).select(F.col("id").alias("cell_id"), *(F.expr(f"cast({e} as double)").alias(a) for a, e in zip(AXES, (f"id div {y * x}", f"id div {x} % {y}", f"id % {x}"), strict=True)))
    moved = transform(grid)
    corners = F.array(*(F.struct(*(F.lit(k).alias(a) for a, k in zip(AXES, o, strict=True))) for o in product((0, 1), repeat=3)))
    laid = moved.withColumn("_o", F.explode(corners))
    weight = F.lit(1.0)
    for a in AXES:
        part = F.col(a) - F.floor(a)
        weight = weight * F.when(F.col(f"_o.{a}") == 1, part).otherwise(1 - part)
    laid = laid.select("cell_id", *((F.floor(a).cast("int") + F.col(f"_o.{a}")).alias(a) for a in AXES), weight.alias("_w")).where("_w > 0")
    read = laid.join(image.select(*(F.col(a).cast("int").alias(a) for a in AXES), "v"), list(AXES)).groupBy("cell_id").agg(F.sum(F.col("_w") * F.col("v")).alias("_v"))
    return grid.join(read, "cell_id", "left").select(*(F.col(a).cast("int").alias(a) for a in AXES), F.coalesce("_v", F.lit(0.0)).alias("v"))
