"""Cubic splines through images in chunks: coefficients, and images seen through a transformation.

The coefficients of the spline through all voxels are a recursive filter along each
axis, run within every chunk.  What a chunk's voxels add to the coefficients of another
chunk falls off by the filter's pole with each step, so that one plane, line or number
for each neighbour carries all of it: one exchange, in which a chunk's own voxels go once
and no voxel is a row.  An image is read at other places by sending each target chunk the
box of coefficients that its places need.

Beyond its borders an image goes on as its mirror image about the centres of the end
voxels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.operators import chunks as B

Shape = tuple[int, int, int]
#: Places (3, n) of a target to places of a source; it travels to the tasks.
Move = Callable[[np.ndarray], np.ndarray]

#: Pole of the cubic spline's filter, and steps after which its power is nothing in double precision.
POLE = math.sqrt(3) - 2
REACH = 36
#: Voxels of a target that are read at once.
SLICE = 1 << 18


def fold(q: int, n: int) -> int:
    """The place within a line of n that its mirror images have at q."""
    if n == 1:
        return 0
    q %= 2 * (n - 1)
    return min(q, 2 * (n - 1) - q)


def _carries(k: int, n: int, c: int) -> list[tuple[int, str, np.ndarray | None]]:
    """(receiver, mode, weights) along an axis of n voxels in chunks of c, for what chunk k sends.

    Mode s is the chunk itself; l and r are the sums of its voxels, weighted by powers of
    the pole, that come to a receiver from below and from above, mirror images included.
    """
    start, stop = k * c, min((k + 1) * c, n)
    out: list[tuple[int, str, np.ndarray | None]] = [(k, "s", None)]
    for r in range(max(0, (start - REACH) // c), min(-(-n // c) - 1, (stop - 1 + REACH) // c) + 1):
        low, high = r * c, min((r + 1) * c, n)
        for mode, places in (("l", [(low - d, d) for d in range(1, REACH + 1)]), ("r", [(high - 1 + d, d) for d in range(1, REACH + 1)])):
            weights = np.zeros(stop - start)
            for q, d in places:
                if (r != k or not start <= q < stop) and start <= (p := fold(q, n)) < stop:
                    weights[p - start] += POLE**d
            if weights.any():
                out.append((r, mode, weights))
    return out


def _both_ways(a: np.ndarray, axis: int) -> np.ndarray:
    """The sums of a line's values times the pole to the power of their distance."""
    up, down = np.moveaxis(a.copy(), axis, 0), np.moveaxis(a.copy(), axis, 0)
    for i in range(1, len(up)):
        up[i] += POLE * up[i - 1]
        down[-1 - i] += POLE * down[-i]
    return np.moveaxis(up + down - np.moveaxis(a, axis, 0), 0, axis)


def _spread(parts: dict[str, np.ndarray], axis: int, n: int) -> np.ndarray:
    """A chunk's coefficients along an axis from its own values and what was carried to it."""
    out = None
    powers = POLE ** np.arange(n)
    shape = [1, 1, 1]
    shape[axis] = n
    for mode, a in parts.items():
        new = _both_ways(a, axis) if mode == "s" else a * (powers if mode == "l" else powers[::-1]).reshape(shape)
        out = new if out is None else out + new
    return math.sqrt(3) * out


def coefficients(chunks: DataFrame, sizes: Shape, chunk: Shape) -> DataFrame:
    """Coefficients (double) of the cubic spline through the voxels of a chunk table without halo."""

    def parts_of(row: dict) -> Iterator[dict]:
        array = B.block(row)
        ways = [_carries(int(row[k]), n, c) for k, n, c in zip(B.KEY, sizes, chunk, strict=True)]
        for z in ways[0]:
            of_z = array if z[2] is None else np.tensordot(z[2], array, (0, 0))[None]
            for y in ways[1]:
                of_y = of_z if y[2] is None else np.tensordot(of_z, y[2], (1, 0))[:, None]
                for x in ways[2]:
                    of_x = of_y if x[2] is None else np.tensordot(of_y, x[2], (2, 0))[:, :, None]
                    place = dict(zip(B.KEY, (z[0], y[0], x[0]), strict=True)) | {f"{a}0": 0 for a in B.AXES} | dict(zip(("nz", "ny", "nx"), of_x.shape, strict=True))
                    yield B.block_row(place, of_x, 0) | {"mode": z[1] + y[1] + x[1]}

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return B.frames_of((part for row in B.records(frames) for part in parts_of(row)), ("mode",))

    def gather(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        start = [int(k) * c for k, c in zip(key, chunk, strict=True)]
        size = [min(c, n - s) for c, n, s in zip(chunk, sizes, start, strict=True)]
        sums: dict[str, np.ndarray] = {}
        for row in parts.to_dict("records"):
            a = B.block(row).astype(np.float64)
            sums[row["mode"]] = sums[row["mode"]] + a if row["mode"] in sums else a
        for axis in (2, 1, 0):
            sums = {rest: _spread({m[axis]: a for m, a in sums.items() if m[:axis] == rest}, axis, size[axis]) for rest in {m[:axis] for m in sums}}
        return B.frame([B.block_row(dict(zip(B.KEY + B.PLACE, [*key, *start, *size], strict=True)), sums[""].astype("<f8"), 0)])

    return chunks.mapInPandas(send, B.SCHEMA + ", mode string").groupBy(*B.KEY).applyInPandas(gather, B.SCHEMA)


def weights(u: np.ndarray) -> np.ndarray:
    """(4, n): the spline's weights of the four coefficients around places with these fractions."""
    v = 1 - u
    return np.stack([v**3 / 6, (3 * u**3 - 6 * u**2 + 4) / 6, (3 * v**3 - 6 * v**2 + 4) / 6, u**3 / 6])


def slopes(u: np.ndarray) -> np.ndarray:
    """(4, n): the derivatives of ``weights``."""
    v = 1 - u
    return np.stack([-(v**2) / 2, (3 * u**2 - 4 * u) / 2, -(3 * v**2 - 4 * v) / 2, u**2 / 2])


def read(box: np.ndarray, low: np.ndarray, places: np.ndarray, order: int = 3, gradient: bool = False) -> np.ndarray:
    """Values at places (3, n), or with ``gradient`` values and three slopes (4, n).

    ``box`` holds coefficients, or for order 1 voxels, from the place ``low`` on, and all that the places need.
    """
    first = np.floor(places).astype(np.int64)
    part = places - first
    if order == 1:
        ways, turns, offsets = np.stack([1 - part, part]), np.stack([-np.ones_like(part), np.ones_like(part)]), range(2)
    else:
        ways, turns, offsets = weights(part), slopes(part), range(-1, 3)
    at = first - low[:, None]
    out = np.zeros((4 if gradient else 1, places.shape[1]))
    for (i, a), (j, b), (k, c) in product(enumerate(offsets), repeat=3):
        v = box[at[0] + a, at[1] + b, at[2] + c]
        z, y, x = ways[i, 0], ways[j, 1], ways[k, 2]
        out[0] += v * (z * y * x)
        if gradient:
            out[1] += v * (turns[i, 0] * y * x)
            out[2] += v * (z * turns[j, 1] * x)
            out[3] += v * (z * y * turns[k, 2])
    return out if gradient else out[0]


def inside(places: np.ndarray, sizes: Shape, slack: float = 0.0) -> np.ndarray:
    """Which places lie within an image, its end voxels' centres and ``slack`` voxels beyond them included."""
    return np.all([(p >= -slack) & (p <= n - 1 + slack) for p, n in zip(places, sizes, strict=True)], axis=0)


def grid(start: list[int], size: list[int]) -> np.ndarray:
    """(3, n): the places of a box's voxels in their order."""
    return np.stack([a.ravel() for a in np.meshgrid(*(np.arange(s, s + n, dtype=np.float64) for s, n in zip(start, size, strict=True)), indexing="ij")])


def _slices(start: list[int], size: list[int]) -> Iterator[tuple[slice, np.ndarray]]:
    """Planes of a box and their places, some at a time."""
    step = max(1, SLICE // max(1, size[1] * size[2]))
    for z in range(0, size[0], step):
        n = min(step, size[0] - z)
        yield slice(z, z + n), grid([start[0] + z, *start[1:]], [n, *size[1:]])


def whole(values: np.ndarray, dtype: str) -> np.ndarray:
    """Values as a type: whole numbers are rounded half up and kept within its range."""
    kind = np.dtype(dtype)
    if kind.kind in "iu":
        values = np.clip(np.floor(values + 0.5), np.iinfo(kind).min, np.iinfo(kind).max)
    return values.astype(kind)


def warp(source: DataFrame, source_sizes: Shape, source_chunk: Shape, sizes: Shape, chunk: Shape, move: Move, dtype: str = "<f8", order: int = 3) -> DataFrame:
    """Chunks of a target of ``sizes`` voxels: each reads the source at the place that ``move`` gives it.

    ``source`` has the source's coefficients, or its voxels for order 1; places outside
    of it are 0.  A target chunk is sent the box of the source around its places, so its
    size bounds what a task holds; a transformation that spreads neighbouring voxels far
    apart wants small ones.
    """
    counts = [-(-n // c) for n, c in zip(sizes, chunk, strict=True)]
    spark = source.sparkSession

    def place(t: int) -> tuple[list[int], list[int], list[int]]:
        key = [t // (counts[1] * counts[2]), t // counts[2] % counts[1], t % counts[2]]
        start = [k * c for k, c in zip(key, chunk, strict=True)]
        return key, start, [min(c, n - s) for c, n, s in zip(chunk, sizes, start, strict=True)]

    def box(start: list[int], size: list[int]) -> tuple[np.ndarray, np.ndarray] | None:
        """The part of the source that a target chunk needs: first voxels and those after the last."""
        low, high = np.full(3, np.inf), np.full(3, -np.inf)
        for _, places in _slices(start, size):
            moved = move(places)
            moved = moved[:, inside(moved, source_sizes)]
            if moved.size:
                low, high = np.minimum(low, moved.min(axis=1)), np.maximum(high, moved.max(axis=1))
        if not np.isfinite(low).all():
            return None
        ends = np.array(source_sizes)
        return np.maximum(np.floor(low).astype(int) - 2, 0), np.minimum(np.floor(high).astype(int) + 4, ends)

    names = [f"{e}{a}" for a in B.AXES for e in ("low_", "high_")]

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in frames:
            for t in part["id"].tolist():
                _, start, size = place(t)
                found = box(start, size)
                if found:
                    low, high = found
                    keys = list(product(*(range(l // c, (h - 1) // c + 1) for l, h, c in zip(low.tolist(), high.tolist(), source_chunk, strict=True))))
                    yield pd.DataFrame(keys, columns=B.KEY).assign(target=t, **dict(zip(names, (int(v) for pair in zip(low, high, strict=True) for v in pair), strict=True)))

    targets = spark.range(math.prod(counts))
    asked = targets.mapInPandas(ask, "chunk_z int, chunk_y int, chunk_x int, target bigint, " + ", ".join(f"{n} bigint" for n in names))
    by_chunk = asked.groupBy(*B.KEY).agg(F.collect_list(F.struct("target", *names)).alias("asked"))

    def parts_of(row: dict) -> Iterator[dict]:
        array, at = B.block(row), [int(row[f"{a}0"]) for a in B.AXES]
        for want in row["asked"]:
            lows = [max(int(want[f"low_{a}"]), s) for a, s in zip(B.AXES, at, strict=True)]
            highs = [min(int(want[f"high_{a}"]), s + n) for a, s, n in zip(B.AXES, at, array.shape, strict=True)]
            piece = array[tuple(slice(l - s, h - s) for l, h, s in zip(lows, highs, at, strict=True))]
            yield B.block_row(dict(zip(B.KEY + B.PLACE, [0, 0, 0, *lows, *piece.shape], strict=True)), piece, 0) | {"target": int(want["target"])}

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return B.frames_of((part for row in B.records(frames) for part in parts_of(row)), ("target",))

    pieces = source.join(by_chunk, B.KEY).mapInPandas(cut, B.SCHEMA + ", target bigint")
    empty = targets.selectExpr(*(f"0 as {k}" for k in B.KEY), *(f"0L as {a}0" for a in B.AXES), *(f"0 as n{a}" for a in B.AXES), "0 as halo", "'<f8' as dtype", "cast('' as binary) as payload", "id as target")

    def fill(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        at, start, size = place(int(key[0]))
        out = np.zeros(size)
        parts = parts[parts["nz"] > 0].to_dict("records")
        if parts:
            low = np.array([min(int(r[f"{a}0"]) for r in parts) for a in B.AXES])
            high = np.array([max(int(r[f"{a}0"]) + int(r[f"n{a}"]) for r in parts) for a in B.AXES])
            held = np.zeros(high - low)
            for r in parts:
                piece = B.block(r)
                held[tuple(slice(int(r[f"{a}0"]) - s, int(r[f"{a}0"]) - s + n) for a, s, n in zip(B.AXES, low.tolist(), piece.shape, strict=True))] = piece
            pad = [(2 if l == 0 else 0, 2 if h == n else 0) for l, h, n in zip(low, high, source_sizes, strict=True)]
            held = np.pad(held, pad, mode="reflect")
            low = low - np.array([p[0] for p in pad])
            for planes, places in _slices(start, size):
                moved = move(places)
                here = inside(moved, source_sizes)
                values = np.zeros(moved.shape[1])
                values[here] = read(held, low, moved[:, here], order)
                out[planes] = values.reshape(out[planes].shape)
        return B.frame([B.block_row(dict(zip(B.KEY + B.PLACE, [*at, *start, *size], strict=True)), whole(out, dtype), 0)])

    return pieces.unionByName(empty).groupBy("target").applyInPandas(fill, B.SCHEMA)


def warp_image(image: DataFrame, image_sizes: Shape, image_chunk: Shape, sizes: Shape, chunk: Shape, move: Move, dtype: str = "<f8") -> DataFrame:
    """A chunked image seen from another space, by the cubic spline through its voxels."""
    return warp(coefficients(image, image_sizes, image_chunk), image_sizes, image_chunk, sizes, chunk, move, dtype)
