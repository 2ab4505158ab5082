"""Cell tables: coordinates into the atlas, and the region at each cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.functions.scalar import round_half_even

AXES = ("z", "y", "x")


def scale_and_trim(points: DataFrame, rough: tuple[float, float, float], fine: tuple[float, float, float], starts: tuple[int | None, int | None, int | None] = (None, None, None)) -> DataFrame:
    """Raw coordinates in the space of the downsampled, trimmed image: c / rough * fine - start."""
    return points.withColumns({c: F.col(c).cast("double") / F.lit(float(r)) * F.lit(float(f)) - F.lit(float(s or 0)) for c, r, f, s in zip(AXES, rough, fine, starts, strict=True)})


def affine(points: DataFrame, matrix: list[list[float]], offset: list[float]) -> DataFrame:
    """matrix @ (z, y, x) + offset: a projection."""
    rows = {c: sum((F.col(a).cast("double") * F.lit(float(m)) for a, m in zip(AXES, row, strict=True)), F.lit(float(b))) for c, row, b in zip(AXES, matrix, offset, strict=True)}
    return points.withColumns(rows)


def attach_transformed(cells: DataFrame, transformed: DataFrame) -> DataFrame:
    """Cells with their transformed coordinates, by ``cell_id``."""
    return cells.join(transformed.select("cell_id", *(F.col(c).alias(f"{c}_trfm") for c in AXES)), "cell_id", "left")


def in_bounds(shape: tuple[int, int, int], columns: tuple[str, str, str] = AXES):
    """Predicate: every coordinate within 0 <= c < size."""
    tests = [(F.col(c) >= 0) & (F.col(c) < n) for c, n in zip(columns, shape, strict=True)]
    return tests[0] & tests[1] & tests[2]


def region_lookup(cells: DataFrame, annotation: DataFrame, *, columns: tuple[str, str, str] = ("z_trfm", "y_trfm", "x_trfm"), oob: str = "null") -> DataFrame:
    """Cells with the id of the annotation voxel at their rounded coordinates.

    ``annotation`` has z, y, x, id.  Out of its bounds the id is NULL, or -1 with
    ``oob="invalid"``.  Cells shuffle on the voxel only where the annotation is too
    large to broadcast; the planner decides by its size.
    """
    if oob not in ("null", "invalid"):
        raise ValueError("oob is null or invalid")
    places = cells.withColumns({f"_{a}": round_half_even(c) for a, c in zip(AXES, columns, strict=True)})
    grid = annotation.select(*(F.col(a).cast("int").alias(f"_{a}") for a in AXES), F.col("id").cast("bigint").alias("id"))
    out = places.drop("id").join(grid, [f"_{a}" for a in AXES], "left").drop(*(f"_{a}" for a in AXES))
    return out.withColumn("id", F.coalesce("id", F.lit(-1).cast("bigint"))) if oob == "invalid" else out


def volume_between(cells: DataFrame, least: int | None, most: int | None) -> DataFrame:
    """Cells whose volume lies within the bounds, ends included; a bound of None or 0 is none."""
    if least:
        cells = cells.where(F.col("volume") >= least)
    return cells.where(F.col("volume") <= most) if most else cells
