"""Neighbourhood filters on dense voxel tables.

Separable filters run along one axis after the other.  For each axis the volume is
grouped into lines (arrays of the axis' length), and the filter is an expression over
the array: one shuffle an axis, no row multiplied by the size of the window.

Windows of even size cover the offsets -size/2 .. size/2 - 1; the second half of an
opening or closing uses the mirrored window.  Beyond the ends a line is continued by
its mirror image, edges included.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
#: Steps on each side of a point that take part in a spline.
SPLINE_REACH = 32


def along(voxels: DataFrame, axis: str, value) -> DataFrame:
    """Replace v by ``value(line, i)`` along an axis, where line is the array of its voxels."""
    others = [a for a in AXES if a != axis]
    lines = voxels.groupBy(*others).agg(F.sort_array(F.collect_list(F.struct(axis, "v"))).alias("_line"))
    new = F.transform("_line", lambda c, i: F.struct(c[axis].alias(axis), value(F.col("_line"), i).alias("v")))
    return lines.select(*others, F.explode(new).alias("_c")).select(*others, f"_c.{axis}", "_c.v").select(*AXES, "v")


def mirrored(line: Column, i: Column) -> Column:
    """The value at place i of a line that is continued by its mirror images."""
    n = F.size(line)
    j = F.pmod(i, 2 * n)
    return F.get(line, F.when(j < n, j).otherwise(2 * n - 1 - j))["v"]


def window(size: int, mirror: bool = False) -> tuple[int, int]:
    """First and last offset of a window of this size."""
    low, high = -(size // 2), size - size // 2 - 1
    return (-high, -low) if mirror else (low, high)


def _ranked(voxels: DataFrame, size: int, best, mirror: bool) -> DataFrame:
    low, high = window(size, mirror)
    for axis in AXES:
        voxels = along(voxels, axis, lambda line, i: best(F.transform(F.sequence(i + low, i + high), lambda j: mirrored(line, j))))
    return voxels


def min_filter(voxels: DataFrame, size: int, mirror: bool = False) -> DataFrame:
    return _ranked(voxels, size, F.array_min, mirror)


def max_filter(voxels: DataFrame, size: int, mirror: bool = False) -> DataFrame:
    return _ranked(voxels, size, F.array_max, mirror)


def opening(voxels: DataFrame, size: int) -> DataFrame:
    return max_filter(min_filter(voxels, size), size, mirror=True)


def _minus(voxels: DataFrame, other: DataFrame) -> DataFrame:
    """v - other, not below 0."""
    return voxels.join(other.select(*AXES, F.col("v").alias("_o")), list(AXES)).select(*AXES, F.greatest(F.col("v") - F.col("_o"), F.lit(0)).alias("v"))


def tophat(voxels: DataFrame, size: int = 10) -> DataFrame:
    """White top-hat: what an opening takes away."""
    return _minus(voxels, opening(voxels, size))


def gaussian_weights(sigma: float, truncate: float = 4.0, unit: int | None = None) -> list[float] | list[int]:
    """Weights at the offsets -r..r with r = int(truncate * sigma + 0.5), adding up to 1.

    With ``unit`` they are whole numbers of 1/unit, so that sums are exact.
    """
    r = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-r, r + 1)]
    total = sum(raw)
    return [w / total for w in raw] if unit is None else [round(unit * w / total) for w in raw]


def convolve(voxels: DataFrame, weights: list) -> DataFrame:
    """Weighted sums along each axis; whole weights give whole sums (not divided)."""
    r = len(weights) // 2
    kind = "bigint" if all(isinstance(w, int) for w in weights) else "double"
    array = F.array(*(F.lit(w).cast(kind) for w in weights))
    for axis in AXES:
        voxels = along(voxels, axis, lambda line, i: F.aggregate(F.sequence(F.lit(0), F.lit(2 * r)), F.lit(0).cast(kind), lambda s, k: s + F.get(array, k) * mirrored(line, i + k - r).cast(kind)))
    return voxels


def gaussian(voxels: DataFrame, sigma: float, unit: int | None = None) -> DataFrame:
    """Gaussian blur; with ``unit`` in whole arithmetic, divided and rounded down at the end."""
    out = convolve(voxels, gaussian_weights(sigma, unit=unit))
    return out if unit is None else out.withColumn("v", F.expr(f"v div {unit**3}L"))


def difference_of_gaussians(voxels: DataFrame, sigma1: float = 1, sigma2: float = 2, unit: int | None = None) -> DataFrame:
    return _truncated(_minus(gaussian(voxels, sigma1, unit), gaussian(voxels, sigma2, unit)))


def gaussian_blur(voxels: DataFrame, sigma: float = 10, unit: int | None = None) -> DataFrame:
    return _truncated(gaussian(voxels, sigma, unit))


def gaussian_subtract(voxels: DataFrame, sigma: float = 10, unit: int | None = None) -> DataFrame:
    return _truncated(_minus(voxels, gaussian(voxels, sigma, unit)))


def _truncated(voxels: DataFrame) -> DataFrame:
    return voxels.withColumn("v", F.col("v").cast("bigint"))


def local_maxima(voxels: DataFrame, size: int = 10, mask: DataFrame | None = None) -> DataFrame:
    """1 where a voxel equals the greatest of its window (ties included) and the mask is positive."""
    top = max_filter(voxels, size).select(*AXES, F.col("v").alias("_top"))
    out = voxels.join(top, list(AXES)).select(*AXES, (F.col("v") == F.col("_top")).alias("_is"))
    if mask is not None:
        out = out.join(mask.select(*AXES, F.col("v").alias("_m")), list(AXES), "left").select(*AXES, (F.col("_is") & (F.coalesce("_m", F.lit(0)) > 0)).alias("_is"))
    return out.select(*AXES, F.col("_is").cast("int").alias("v"))


#: The voxel itself and its six neighbours.
CROSS = [(0, 0, 0), (-1, 0, 0), (1, 0, 0), (0, -1, 0), (0, 1, 0), (0, 0, -1), (0, 0, 1)]


def _neighbours(points: DataFrame) -> DataFrame:
    offsets = F.array(*(F.struct(*(F.lit(d).alias(a) for d, a in zip(o, AXES, strict=True))) for o in CROSS))
    return points.select(*AXES, F.explode(offsets).alias("_o")).select(*((F.col(a) + F.col(f"_o.{a}")).alias(a) for a in AXES))


def dilate(points: DataFrame, sizes: tuple[int, int, int], times: int = 1) -> DataFrame:
    """Set voxels and their six neighbours within the volume."""
    for _ in range(times):
        points = _neighbours(points)
        for a, n in zip(AXES, sizes, strict=True):
            points = points.where((F.col(a) >= 0) & (F.col(a) < n))
        points = points.distinct()
    return points


def erode(points: DataFrame, times: int = 1) -> DataFrame:
    """Set voxels whose six neighbours are all set; beyond the volume none is."""
    for _ in range(times):
        points = _neighbours(points).groupBy(*AXES).agg(F.count("*").alias("_n")).where(F.col("_n") == len(CROSS)).select(*AXES)
    return points


def binary_close(points: DataFrame, sizes: tuple[int, int, int], times: int = 2) -> DataFrame:
    return erode(dilate(points, sizes, times), times)


def binary_open(points: DataFrame, sizes: tuple[int, int, int], times: int = 2) -> DataFrame:
    return dilate(erode(points, times), sizes, times)


def _lines(voxels: DataFrame, axis: str) -> tuple[DataFrame, list[str]]:
    """The voxels of each line along an axis as one array, and the columns that tell lines apart."""
    others = [a for a in AXES if a != axis]
    return voxels.groupBy(*others).agg(F.sort_array(F.collect_list(F.struct(axis, "v"))).alias("_line")), others


def _linear(voxels: DataFrame, axis: str, zoom: float) -> DataFrame:
    lines, others = _lines(voxels, axis)
    n = F.size("_line")
    m = F.greatest(F.rint(n * F.lit(float(zoom))), F.lit(1)).cast("int")
    span = F.greatest(m - 1, F.lit(1))

    def at(j: Column) -> Column:
        step = j.cast("bigint") * (n - 1)  # beyond 32 bits from 55,000 voxels on
        first = F.floor(step / span).cast("int")
        left, right = F.get("_line", first)["v"], F.get("_line", F.least(first + 1, n - 1))["v"]
        return F.struct(j.alias(axis), (left + (right - left) * ((step % span) / span)).alias("v"))

    new = F.transform(F.sequence(F.lit(0), m - 1), at)
    return lines.select(*others, F.explode(new).alias("_c")).select(*others, f"_c.{axis}", "_c.v").select(*AXES, "v")


def spline_taps(n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights, each (taps, m), that take n voxels to m by a cubic spline, ends on ends.

    The spline goes through all voxels of the line, which its mirror images continue
    about the centres of the end voxels.  A voxel's share falls by a factor of 3.7 with
    each step away, so that 30 steps on each side exhaust double precision.
    """
    at = np.arange(m) * ((n - 1) / max(m - 1, 1))
    first = np.floor(at).astype(np.int64)
    steps = np.arange(-SPLINE_REACH, SPLINE_REACH + 1)[:, None]
    weights = np.zeros((len(steps), m))
    for k in range(-1, 3):  # the four basis functions over a point; each coefficient is a sum over the line
        t = np.abs(at - first - k)
        basis = np.where(t < 1, 2 / 3 - t * t + t**3 / 2, np.maximum(2 - t, 0) ** 3 / 6)
        weights += basis * math.sqrt(3) * (math.sqrt(3) - 2) ** np.abs(steps - k)
    period = max(2 * (n - 1), 1)
    place = (first + steps) % period
    return np.minimum(place, period - place) if n > 1 else np.zeros_like(place), weights


def _cubic(voxels: DataFrame, axis: str, zoom: float) -> DataFrame:
    lines, others = _lines(voxels, axis)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, sizes = batch.column("_values"), batch.column("_values").value_lengths().to_numpy()
            flat, ends = values.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for n in np.unique(sizes).tolist():  # one length in a whole volume
                rows = np.flatnonzero(sizes == n)
                m = max(round(n * zoom), 1)
                place, weights = spline_taps(n, m)
                for own in np.array_split(rows, -(-len(rows) * max(n, m) // 1_000_000)):
                    line = flat[(ends[own] - n)[:, None] + np.arange(n)]
                    new = np.zeros((len(own), m))
                    for i, w in zip(place, weights, strict=True):
                        new += line[:, i] * w
                    out = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * m), pa.array(new.ravel()))
                    yield pa.RecordBatch.from_arrays([*(batch.column(a).take(pa.array(own)) for a in others), out], [*others, "_values"])

    kinds = dict(voxels.dtypes)
    new = lines.select(*others, F.transform("_line", lambda c: c["v"]).alias("_values")).mapInArrow(run, ", ".join(f"{a} {kinds[a]}" for a in others) + ", _values array<double>")
    return new.select(*others, F.posexplode("_values").alias(axis, "v")).select(*AXES, "v")


def resample(voxels: DataFrame, zooms: tuple[float, float, float], order: int = 3, bits: int | None = None) -> DataFrame:
    """A volume of round(n * zoom) voxels an axis, ends on ends.

    Of order 3 it is a cubic spline through the old voxels, of order 1 linear between
    them.  Values are doubles, or with ``bits`` unsigned whole numbers: rounded half up
    and kept within their range.
    """
    if order not in (1, 3):
        raise ValueError("the order is 1 or 3")
    voxels = voxels.withColumn("v", F.col("v").cast("double"))
    for axis, zoom in zip(AXES, zooms, strict=True):
        if zoom != 1:
            voxels = (_cubic if order == 3 else _linear)(voxels, axis, zoom)
    if bits is None:
        return voxels
    return voxels.withColumn("v", F.least(F.greatest(F.floor(F.col("v") + 0.5), F.lit(0)), F.lit((1 << bits) - 1)).cast("bigint"))
