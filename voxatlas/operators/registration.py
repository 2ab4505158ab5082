"""Registration: the transformation that takes a fixed image's places into a moving one.

The measure is the mutual information of a joint Parzen histogram (cubic windows on
both axes) over sampled voxels of the fixed image and what the moving image has at
their transformed places.  Both images are smoothed and thinned, level by level.  The
moving image stays in chunks, as coefficients of its spline; an evaluation is one pass
over them, in which each task reads the samples that fall into its chunks and sends one
histogram, with its derivatives by the twelve numbers of an affine transformation, or the
derivatives by control points, which are added up by a shuffle on the control point.
Nothing but the samples, whose number is a parameter, the histograms and the parameters
of the transformation is in the driver.

Samples are chosen by a rule over places, so that a registration can be repeated; the
parameters climb by a quasi-Newton method with limited steps.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.operators import chunks as B
from voxatlas.operators import kernels as N
from voxatlas.operators import splines as S
from voxatlas.operators.kept import drop, kept
from voxatlas.operators.transforms import Affine, BSplineField, Chain

#: Least voxels of an axis that a level leaves.
LEAST = 16
#: Partitions at most that send histograms, each a fixed number of bytes.
PARTS = 64
#: Voxels beyond the end voxels' centres at which an image is still read: up to their outer faces.
SLACK = 0.5
#: Multiplier and modulus of the rule that chooses samples.
STRIDE, CYCLE = 2654435761, 1 << 32


@dataclass(frozen=True)
class Settings:
    """Levels, turns of each at most, bins of an axis of the histogram, samples, and for fields
    the voxels between control points of the last level.  Fixed values: the defaults.
    """

    levels: int = 4
    turns: int = 500
    bins: int = 32
    samples: int = 4000
    spacing: tuple[float, float, float] = (25.0, 25.0, 25.0)
    #: A level ends where the measure rises by less than this share.
    least_rise: float = 1e-4

    @classmethod
    def of(cls, given: dict[str, list[str]]) -> Settings:
        """Settings from a parameter file's values; those it has not keep their defaults."""
        names = {"levels": "NumberOfResolutions", "turns": "MaximumNumberOfIterations", "bins": "NumberOfHistogramBins", "samples": "NumberOfSpatialSamples"}
        own = {k: int(given[n][0]) for k, n in names.items() if n in given}
        if "FinalGridSpacingInVoxels" in given:
            own["spacing"] = tuple(float(v) for v in given["FinalGridSpacingInVoxels"][::-1])
        return cls(**own)

    def text(self) -> str:
        """A parameter file of these settings."""
        values = {"NumberOfResolutions": self.levels, "MaximumNumberOfIterations": self.turns, "NumberOfHistogramBins": self.bins, "NumberOfSpatialSamples": self.samples, "FinalGridSpacingInVoxels": " ".join(map(str, self.spacing[::-1]))}
        return "".join(f"({name} {value})\n" for name, value in values.items())


AFFINE, BSPLINE = Settings(), Settings(levels=3, turns=5000, bins=128, samples=10_000)


# ---- levels -------------------------------------------------------------------------


def smooth(chunks: DataFrame, sizes: B.Shape, chunk: B.Shape, sigma: float, mask: DataFrame | None = None) -> DataFrame:
    """A Gaussian blur of a chunk table without halo; with a mask, of the voxels within it alone.

    Places without such a voxel within the reach are 0.
    """
    if sigma <= 0:
        return chunks
    reach = int(4 * sigma + 0.5)
    wide = B.add_halo(chunks, sizes, chunk, reach)
    if mask is None:
        return B.trim_halo(B.map_blocks(wide, lambda block: N.gaussian(block, sigma)))
    both = B.zip_blocks({"image": wide, "mask": B.add_halo(mask, sizes, chunk, reach)})

    def blurred(row: dict) -> dict:
        values, held = (B.block(row, *(f"{name}_{c}" for c in ("payload", "dtype", "halo"))) for name in ("image", "mask"))
        share = N.gaussian(held != 0, sigma)
        out = np.divide(N.gaussian(np.where(held != 0, values, 0), sigma), share, out=np.zeros_like(share), where=share > 0)
        return B.block_row(row, out[(slice(reach, -reach),) * 3], 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return B.frames_of(blurred(row) for row in B.records(frames))

    return both.mapInPandas(run, B.SCHEMA)


def thin(chunks: DataFrame, factors: B.Shape) -> DataFrame:
    """Every factor-th voxel of an axis; chunks begin at multiples of the factors."""

    def part_of(row: dict) -> dict:
        array = B.block(row)[tuple(slice(None, None, f) for f in factors)]
        place = {k: row[k] for k in B.KEY} | {f"{a}0": int(row[f"{a}0"]) // f for a, f in zip(B.AXES, factors, strict=True)} | dict(zip(("nz", "ny", "nx"), array.shape, strict=True))
        return B.block_row(place, array, 0)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return B.frames_of(part_of(row) for row in B.records(frames))

    return chunks.mapInPandas(run, B.SCHEMA)


@dataclass(frozen=True)
class Image:
    """A chunk table without halo, its voxels an axis and those of a chunk.

    ``mask``, chunks of the same grid, tells by values other than 0 which voxels there are;
    without it all are.  Others give no samples, do not count for the range of values, and
    take no part in a blur.
    """

    chunks: DataFrame
    sizes: B.Shape
    chunk: B.Shape
    mask: DataFrame | None = None

    def level(self, factor: int) -> tuple[Image, B.Shape]:
        """The image smoothed and thinned by up to ``factor``, and by how much an axis was."""
        factors = tuple(max(f for f in (1, 2, 4, 8, 16, 32) if f <= factor and (f == 1 or n // f >= LEAST and c % f == 0)) for n, c in zip(self.sizes, self.chunk, strict=True))
        if max(factors) == 1:
            return self, factors
        blurred = smooth(self.chunks, self.sizes, self.chunk, max(factors) / 2, self.mask)
        sizes = tuple(-(-n // f) for n, f in zip(self.sizes, factors, strict=True))
        mask = None if self.mask is None else thin(self.mask, factors)
        return Image(thin(blurred, factors), sizes, tuple(c // f for c, f in zip(self.chunk, factors, strict=True)), mask), factors

    def kept(self, paths: list[str]) -> Image:
        """The image with its tables written, to be dropped by ``paths``."""
        return replace(self, chunks=kept(self.chunks, paths), mask=None if self.mask is None else kept(self.mask, paths))

    def each(self, f: Callable[[dict, np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
        """Rows of ``f(place, voxels, which of them there are)`` for each chunk."""
        zipped = B.zip_blocks({"image": self.chunks} | ({} if self.mask is None else {"mask": self.mask}))
        masked = self.mask is not None

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for row in B.records(frames):
                v = B.block(row, "image_payload", "image_dtype", "image_halo")
                held = B.block(row, "mask_payload", "mask_dtype", "mask_halo") != 0 if masked else np.ones(v.shape, bool)
                if held.any():
                    yield f(row, v, held)

        return zipped.mapInPandas(run, schema)

    def count(self) -> int:
        """How many voxels there are."""
        if self.mask is None:
            return math.prod(self.sizes)
        return self.each(lambda row, v, held: pd.DataFrame({"n": [int(held.sum())]}), "n long").agg(F.sum("n")).head()[0] or 0

    def range(self) -> tuple[float, float]:
        """Least and greatest value."""
        ends = self.each(lambda row, v, held: pd.DataFrame({"low": [float(v[held].min())], "high": [float(v[held].max())]}), "low double, high double")
        r = ends.agg(F.min("low").alias("low"), F.max("high").alias("high")).head()
        return r["low"], r["high"]


@dataclass(frozen=True, eq=False)
class Samples:
    """Places (3, n) of the fixed image in whole voxels of its finest level, and its values there."""

    places: np.ndarray
    values: np.ndarray


def sample(image: Image, factors: B.Shape, most: int, turn: int = 0) -> Samples:
    """About ``most`` voxels of a level: those whose number times STRIDE falls into the first part of CYCLE."""
    total = image.count()
    bound = min(CYCLE, CYCLE * most // total) if total > most else CYCLE
    ny, nx = image.sizes[1:]

    def chosen(row: dict, array: np.ndarray, held: np.ndarray) -> pd.DataFrame:
        z, y, x = (np.arange(n, dtype=np.uint64) + np.uint64(row[f"{a}0"]) for a, n in zip(B.AXES, array.shape, strict=True))
        number = (z[:, None, None] * np.uint64(ny) + y[:, None]) * np.uint64(nx) + x + np.uint64(turn)
        at = np.nonzero((number * np.uint64(STRIDE) % np.uint64(CYCLE) < bound) & held)
        return pd.DataFrame({a: (p + int(row[f"{a}0"])) * f for a, p, f in zip(B.AXES, at, factors, strict=True)} | {"v": array[at].astype(float)})

    found = image.each(chosen, "z long, y long, x long, v double").toPandas().sort_values(list(B.AXES))
    return Samples(found[list(B.AXES)].to_numpy(float).T.copy(), found["v"].to_numpy(float))


# ---- the measure --------------------------------------------------------------------


def windows(values: np.ndarray, low: float, high: float, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bin, weights (4, n) and their slopes by the value, of the window around each value."""
    scale = (bins - 3) / (high - low) if high > low else 0.0
    t = 1 + (np.clip(values, low, high) - low) * scale
    first = np.minimum(np.floor(t).astype(np.int64), bins - 3)
    within = (values > low) & (values < high)
    return first - 1, S.weights(t - first), S.slopes(t - first) * (scale * within)


def information(joint: np.ndarray) -> tuple[float, np.ndarray]:
    """The mutual information of a joint histogram, and log(p / p of the moving value) by bin."""
    total = joint.sum()
    if total <= 0:
        return 0.0, np.zeros_like(joint)
    p = joint / total
    f, m = p.sum(axis=1, keepdims=True), p.sum(axis=0, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(p > 0, p * np.log(p / (f * m)), 0).sum()
        weight = np.where(p > 0, np.log(p / m), 0)
    return float(value), weight


class Measure:
    """The mutual information of samples and a level of the moving image, and its slopes."""

    def __init__(self, moving: Image, factors: B.Shape, samples: Samples, bins: int, order: int = 3):
        self.moving, self.factors, self.samples, self.bins, self.order = moving, np.array(factors, float), samples, bins, order
        self.fixed_range = (float(samples.values.min()), float(samples.values.max())) if len(samples.values) else (0.0, 0.0)
        self.moving_range = moving.range()
        made = S.coefficients(moving.chunks, moving.sizes, moving.chunk) if order == 3 else moving.chunks
        self.paths: list[str] = []
        self.made = kept(B.add_halo(made, moving.sizes, moving.chunk, 2, mode="reflect"), self.paths).coalesce(PARTS).persist()

    def close(self) -> None:
        """Give back what the measure has kept."""
        self.made.unpersist()
        drop(self.made.sparkSession, self.paths)

    def _each(self, places: np.ndarray, f: Callable, schema: str) -> DataFrame:
        """Rows of ``f(which samples, their values, their slopes)`` for each partition's samples together."""
        scale, sizes, order = self.factors[:, None], self.moving.sizes, self.order
        moved = self.made.sparkSession.sparkContext.broadcast(places / scale)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            at = moved.value
            held = S.inside(at, sizes, SLACK)
            first = np.maximum(np.floor(at), 0)
            ids, values, turns = [], [], []
            for part in frames:
                for row in part.to_dict("records"):
                    here = held.copy()
                    for k, a in enumerate(B.AXES):
                        here &= (first[k] >= row[f"{a}0"]) & (first[k] < row[f"{a}0"] + row[f"n{a}"])
                    which = np.flatnonzero(here)
                    if len(which):
                        low = np.array([int(row[f"{a}0"]) - int(row["halo"]) for a in B.AXES])
                        got = S.read(B.block(row), low, at[:, which], order, gradient=True)
                        ids.append(which)
                        values.append(got[0])
                        turns.append(got[1:] / scale)
            if ids:
                yield f(np.concatenate(ids), np.concatenate(values), np.concatenate(turns, axis=1))

        return self.made.mapInPandas(run, schema)

    def _joint(self, which: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list]:
        """The histogram of some samples, and (bins, weight, slope by the moving value) of its sixteen terms."""
        ff, wf, _ = windows(self.samples.values[which], *self.fixed_range, self.bins)
        fm, wm, dm = windows(values, *self.moving_range, self.bins)
        joint, terms = np.zeros(self.bins * self.bins), []
        for i, j in product(range(4), repeat=2):
            at = (ff + i) * self.bins + fm + j
            joint += np.bincount(at, wf[i] * wm[j], len(joint))
            terms.append((at, wf[i] * dm[j]))
        return joint, terms

    def _plain(self) -> Measure:
        """What the tasks need of this: not the tables."""
        out = object.__new__(Measure)
        out.samples, out.bins, out.fixed_range, out.moving_range = self.samples, self.bins, self.fixed_range, self.moving_range
        return out

    def joint(self, move: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The joint histogram (fixed, moving) under a transformation."""
        plain = self._plain()
        rows = self._each(move(self.samples.places), lambda which, v, d: pd.DataFrame({"joint": [plain._joint(which, v)[0].tobytes()]}), "joint binary").collect()
        return sum((np.frombuffer(r["joint"]) for r in rows), np.zeros(self.bins**2)).reshape(self.bins, self.bins)

    def affine(self, move: Affine) -> tuple[float, np.ndarray]:
        """The measure under an affine transformation, and its slopes by matrix (by rows) and offset."""
        plain, bins = self._plain(), self.bins
        arms = self.samples.places - move.centre[:, None]

        def run(which: np.ndarray, values: np.ndarray, turns: np.ndarray) -> pd.DataFrame:
            joint, terms = plain._joint(which, values)
            by = np.concatenate([(turns[:, None] * arms[None, :, which]).reshape(9, -1), turns])
            slope = np.zeros((12, bins * bins))
            for at, w in terms:
                for k in range(12):
                    slope[k] += np.bincount(at, w * by[k], bins * bins)
            return pd.DataFrame({"joint": [joint.tobytes()], "slope": [slope.tobytes()]})

        rows = self._each(move(self.samples.places), run, "joint binary, slope binary").collect()
        joint = sum((np.frombuffer(r["joint"]) for r in rows), np.zeros(bins**2))
        slope = sum((np.frombuffer(r["slope"]) for r in rows), np.zeros(12 * bins**2)).reshape(12, -1)
        value, weight = information(joint.reshape(bins, bins))
        return value, slope @ weight.ravel() / max(joint.sum(), 1e-300)

    def field(self, before: Callable, field: BSplineField, joint: np.ndarray) -> np.ndarray:
        """The slopes of the measure by a field's control points (z, y, x, 3); it applies after ``before``."""
        plain, shape = self._plain(), field.grid.shape[:3]
        weight = information(joint)[1].ravel() / max(joint.sum(), 1e-300)
        given = before(self.samples.places)

        def run(which: np.ndarray, values: np.ndarray, turns: np.ndarray) -> pd.DataFrame:
            share = sum(w * weight[at] for at, w in plain._joint(which, values)[1])
            first, near, held = field.around(given[:, which])
            push = (turns * share)[:, held]
            first, near = first[:, held], near[:, :, held]
            sums = np.zeros((3, math.prod(shape)))
            for i, j, k in product(range(4), repeat=3):
                at = np.ravel_multi_index((first[0] + i, first[1] + j, first[2] + k), shape)
                w = near[i, 0] * near[j, 1] * near[k, 2]
                for a in range(3):
                    sums[a] += np.bincount(at, push[a] * w, sums.shape[1])
            some = np.flatnonzero(sums.any(axis=0))
            return pd.DataFrame({"control": some, **{a: sums[k, some] for k, a in enumerate(B.AXES)}})

        rows = self._each(field(given), run, "control long, z double, y double, x double").groupBy("control").agg(*(F.sum(a).alias(a) for a in B.AXES)).toPandas()
        out = np.zeros((math.prod(shape), 3))
        out[rows["control"].to_numpy(int)] = rows[list(B.AXES)].to_numpy(float)
        return out.reshape(*shape, 3)


# ---- climbing -----------------------------------------------------------------------


def climb(value: Callable[[np.ndarray], float], slope: Callable[[np.ndarray], np.ndarray], w: np.ndarray, turns: int, longest: float, least_rise: float, memory: int = 6) -> tuple[np.ndarray, float]:
    """Parameters of a higher value: L-BFGS, no parameter changing by more than ``longest`` in a turn."""
    now = value(w)
    g = slope(w)
    steps: list[np.ndarray] = []
    turned: list[np.ndarray] = []
    for _ in range(turns):
        way, shares = g.copy(), []
        for s, y in zip(reversed(steps), reversed(turned), strict=True):
            shares.append((s @ way) / (s @ y))
            way -= shares[-1] * y
        if steps:
            way *= -(steps[-1] @ turned[-1]) / (turned[-1] @ turned[-1])
        for s, y, a in zip(steps, turned, reversed(shares), strict=True):
            way += s * (-a - (y @ way) / (s @ y))
        if way @ g <= 0:
            way, steps, turned = g.copy(), [], []
        size = np.abs(way).max()
        if size == 0:
            break
        if not steps or size > longest:
            way *= longest / size
        step, rose = 1.0, False
        for _ in range(8):
            then = value(w + step * way)
            if then > now + 1e-4 * step * (g @ way):
                rose = True
                break
            step /= 2
        if not rose:
            if not steps and longest < 1e-2:
                break
            steps, turned = [], []
            longest /= 4
            continue
        new = w + step * way
        new_g = slope(new)
        if (new - w) @ (new_g - g) < -1e-16:
            steps, turned = [*steps, new - w][-memory:], [*turned, new_g - g][-memory:]
        small = then - now < least_rise * max(abs(now), 1e-12)
        w, g, now = new, new_g, then
        if small:
            break
    return w, now


@dataclass(frozen=True)
class Found:
    """A transformation and the measure after each level."""

    move: object
    values: list[float]


def register_affine(fixed: Image, moving: Image, settings: Settings = AFFINE) -> Found:
    """The affine transformation of the highest measure; it begins with the images' middles on each other."""
    middle = lambda image: (np.array(image.sizes, float) - 1) / 2
    centre = middle(fixed)
    arm = max(float(np.linalg.norm(centre)), 1.0)
    scale = np.concatenate([np.full(9, 1 / arm), np.ones(3)])  # a step of one moves the rim by a voxel
    w = np.concatenate([np.eye(3).ravel() * arm, middle(moving) - centre])
    make = lambda w: Affine((w[:9] / arm).reshape(3, 3), w[9:], centre)
    values = []
    for level in range(settings.levels - 1, -1, -1):
        (a, by_fixed), (b, by_moving) = fixed.level(1 << level), moving.level(1 << level)
        used: list[str] = []
        a, b = a.kept(used), b.kept(used)
        measure = Measure(b, by_moving, sample(a, by_fixed, settings.samples), settings.bins)
        last: dict[bytes, tuple[float, np.ndarray]] = {}

        def both(w: np.ndarray) -> tuple[float, np.ndarray]:
            if w.tobytes() not in last:  # noqa: B023
                got = measure.affine(make(w))  # noqa: B023
                last.clear()  # noqa: B023
                last[w.tobytes()] = (got[0], got[1] * scale)  # noqa: B023
            return last[w.tobytes()]  # noqa: B023

        try:
            w, value = climb(lambda w: both(w)[0], lambda w: both(w)[1], w, settings.turns, float(1 << level), settings.least_rise)
        finally:
            measure.close()
            drop(fixed.chunks.sparkSession, used)
        values.append(value)
    return Found(make(w), values)


def register_bspline(fixed: Image, moving: Image, before: Callable = Chain(()), settings: Settings = BSPLINE) -> Found:
    """The field, applied after ``before``, of the highest measure, its grid refined with each level."""
    first = tuple(s * (1 << (settings.levels - 1)) for s in settings.spacing)
    field, values = BSplineField.still(moving.sizes, first), []
    for level in range(settings.levels - 1, -1, -1):
        (a, by_fixed), (b, by_moving) = fixed.level(1 << level), moving.level(1 << level)
        used: list[str] = []
        a, b = a.kept(used), b.kept(used)
        measure = Measure(b, by_moving, sample(a, by_fixed, settings.samples), settings.bins)
        shape, last = field.grid.shape, {}

        def make(w: np.ndarray) -> BSplineField:
            return BSplineField(w.reshape(shape), field.origin, field.spacing)  # noqa: B023

        def value(w: np.ndarray) -> float:
            own = make(w)
            last[w.tobytes()] = joint = measure.joint(lambda p: own(before(p)))  # noqa: B023
            return information(joint)[0]

        def slope(w: np.ndarray) -> np.ndarray:
            joint = last.get(w.tobytes())  # noqa: B023
            last.clear()  # noqa: B023
            return measure.field(before, make(w), joint).ravel()  # noqa: B023

        try:
            w, rise = climb(value, slope, field.grid.ravel(), settings.turns, float(1 << level), settings.least_rise)
        finally:
            measure.close()
            drop(fixed.chunks.sparkSession, used)
        field = make(w)
        values.append(rise)
        if level:
            field = field.refined()
    return Found(field, values)


def register(fixed: Image, moving: Image, affine: Settings = AFFINE, bspline: Settings | None = BSPLINE) -> Chain:
    """The transformation of the fixed image's places into the moving one: affine, then a field."""
    first = register_affine(fixed, moving, affine).move
    if bspline is None:
        return Chain((first,))
    return Chain((first, register_bspline(fixed, moving, first, bspline).move))
