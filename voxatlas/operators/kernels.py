"""Kernels on one block of a volume, for tasks over chunk tables.

Borders are continued by mirror images, edges included; windows of even size cover
-size/2 .. size/2 - 1.
"""

from __future__ import annotations

import heapq

import numpy as np

from voxatlas.operators.stencils import gaussian_weights, window


def _along(block: np.ndarray, axis: int, low: int, high: int) -> np.ndarray:
    """The block padded along an axis for offsets low..high."""
    pad = [(0, 0)] * block.ndim
    pad[axis] = (max(0, -low), max(0, high))
    return np.moveaxis(np.pad(block, pad, mode="symmetric"), axis, 0)


#: Weights from which on a convolution is done by Fourier transforms, and voxels that one takes at once.
MANY, LINES = 64, 1 << 22


def convolve(block: np.ndarray, weights: list[float]) -> np.ndarray:
    """Weighted sums along each axis; those of many weights by Fourier transforms of the lines."""
    r = len(weights) // 2
    for axis in range(block.ndim):
        n = block.shape[axis]
        padded = _along(block, axis, -r, r)
        out = np.zeros((n, *padded.shape[1:]), padded.dtype)
        if len(weights) < MANY:
            for k, w in enumerate(weights):
                out += padded.dtype.type(w) * padded[k : k + n]
        else:
            size = 1 << (n + 4 * r).bit_length()
            factor = np.fft.rfft(np.array(weights)[::-1], size)[:, None]
            lines, made = padded.reshape(len(padded), -1), out.reshape(n, -1)
            step = max(1, LINES // size)
            for k in range(0, lines.shape[1], step):
                made[:, k : k + step] = np.fft.irfft(np.fft.rfft(lines[:, k : k + step], size, axis=0) * factor, size, axis=0)[2 * r : 2 * r + n]
        block = np.moveaxis(out, 0, axis)
    return block


def gaussian(block: np.ndarray, sigma: float) -> np.ndarray:
    return convolve(block.astype(np.float32), gaussian_weights(sigma))


def _ranked(block: np.ndarray, size: int, best, mirror: bool = False) -> np.ndarray:
    """The best value of a window around each voxel; windows double until two of them cover it."""
    low, high = window(size, mirror)
    for axis in range(block.ndim):
        n = block.shape[axis]
        padded = _along(block, axis, low, high)
        first = low + max(0, -low)
        out, wide = padded[first : first + n + size - 1], 1
        while 2 * wide <= size:
            out = best(out[:-wide], out[wide:])
            wide *= 2
        out = best(out[:n], out[size - wide : size - wide + n])
        block = np.moveaxis(out, 0, axis)
    return block


def min_filter(block: np.ndarray, size: int) -> np.ndarray:
    return _ranked(block, size, np.minimum)


def max_filter(block: np.ndarray, size: int, mirror: bool = False) -> np.ndarray:
    return _ranked(block, size, np.maximum, mirror)


def tophat(block: np.ndarray, size: int) -> np.ndarray:
    v = block.astype(np.float32)
    return np.maximum(v - max_filter(min_filter(v, size), size, mirror=True), 0)


def local_maxima(block: np.ndarray, size: int, mask: np.ndarray | None = None) -> np.ndarray:
    top = block == max_filter(block, size)
    return top if mask is None else top & (mask > 0)


def _touching(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of set voxels that touch, by their place in the block."""
    place = np.arange(mask.size).reshape(mask.shape)
    a, b = [], []
    for axis in range(mask.ndim):
        lo, hi = [slice(None)] * mask.ndim, [slice(None)] * mask.ndim
        lo[axis], hi[axis] = slice(None, -1), slice(1, None)
        both = mask[tuple(lo)] & mask[tuple(hi)]
        a.append(place[tuple(lo)][both])
        b.append(place[tuple(hi)][both])
    return np.concatenate(a), np.concatenate(b)


def label(mask: np.ndarray) -> np.ndarray:
    """Six-connected components, numbered from 1 by their first voxels; 0 elsewhere."""
    mask = mask != 0
    a, b = _touching(mask)
    name = np.arange(mask.size)
    while True:
        least = name.copy()
        np.minimum.at(least, a, name[b])
        np.minimum.at(least, b, name[a])
        least = least[least]
        if np.array_equal(least, name):
            break
        name = least
    out = np.zeros(mask.size, np.uint32)
    inside = mask.ravel()
    out[inside] = np.unique(name[inside], return_inverse=True)[1] + 1
    return out.reshape(mask.shape)


def volumes(labels: np.ndarray) -> np.ndarray:
    """Each voxel's label replaced by the label's voxel count."""
    counts = np.bincount(labels.ravel())
    counts[0] = 0
    return counts[labels]


def watershed(raw: np.ndarray, markers: np.ndarray, mask: np.ndarray, unsigned: bool = True) -> np.ndarray:
    """Markers grown over the mask from bright to dark, neighbours first come first served.

    Pieces of the mask that do not touch have nothing to do with each other, so only the
    box of each piece with a marker is flooded.
    """
    out = np.zeros(raw.shape, np.uint32)
    pieces = label(mask)
    wanted = np.unique(pieces[(markers > 0) & (mask != 0)])
    at = np.flatnonzero(pieces)
    if not len(at) or not len(wanted):
        return out
    of = pieces.ravel()[at].astype(np.int64)
    places = np.unravel_index(at, raw.shape)
    low, high = (np.full((raw.ndim, int(of.max()) + 1), v, np.int64) for v in (np.iinfo(np.int64).max, -1))
    for axis, place in enumerate(places):
        np.minimum.at(low[axis], of, place)
        np.maximum.at(high[axis], of, place)
    for piece in wanted[wanted > 0].tolist():
        box = tuple(slice(int(a), int(b) + 1) for a, b in zip(low[:, piece], high[:, piece], strict=True))
        inside = pieces[box] == piece
        grown = _flooded(raw[box], np.where(inside, markers[box], 0), inside, unsigned)
        out[box][inside] = grown[inside]
    return out


def _flooded(raw: np.ndarray, markers: np.ndarray, mask: np.ndarray, unsigned: bool) -> np.ndarray:
    """One piece flooded, in order of level and then of arrival.

    With ``unsigned`` the intensity is negated in 16-bit arithmetic, where 0 stays the
    lowest level and is reached first.
    """
    level = ((-raw.astype(np.int64)) % 65536 if unsigned else -raw.astype(np.int64)).ravel()
    pad = np.pad(mask != 0, 1)
    shape = pad.shape
    steps = [s * d for d in (shape[1] * shape[2], shape[2], 1) for s in (-1, 1)]
    inner = np.arange(pad.size).reshape(shape)[1:-1, 1:-1, 1:-1].ravel()
    back = np.full(pad.size, -1)
    back[inner] = np.arange(raw.size)
    free, back_list, levels = pad.ravel().tolist(), back.tolist(), level.tolist()
    out = [0] * pad.size
    heap, age = [], 0
    for at, m in zip(inner.tolist(), markers.ravel().tolist(), strict=True):
        if m and free[at]:
            out[at] = m
            heap.append((levels[back_list[at]], age, at))
            age += 1
    heapq.heapify(heap)
    while heap:
        _, _, at = heapq.heappop(heap)
        for step in steps:
            near = at + step
            if free[near] and not out[near]:
                out[near] = out[at]
                heapq.heappush(heap, (levels[back_list[near]], age, near))
                age += 1
    return np.array(out, np.uint32)[inner].reshape(raw.shape)


def cells_of_labels(overlap: np.ndarray, labels: np.ndarray, mask: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """Cells of a block whose maxima are labelled already, halo included.

    The watershed starts from all labels, so that cells of the halo take what is theirs;
    those whose first voxel lies in the core are given, with places from the core's
    first voxel, unless nothing is left to them.
    """
    grown = watershed(overlap, labels, mask)
    n = int(labels.max(initial=0))
    found, first = np.unique(labels.ravel(), return_index=True)
    found, first = found[found > 0].astype(np.int64), first[found > 0]
    places = np.array(np.unravel_index(first, labels.shape)).reshape(labels.ndim, -1) - depth
    core = np.array(labels.shape)[:, None] - 2 * depth
    volume = np.bincount(grown.ravel(), minlength=n + 1)[found]
    total = np.bincount(grown.ravel(), weights=overlap.ravel().astype(np.float64), minlength=n + 1)[found]
    own = ((places >= 0) & (places < core)).all(axis=0) & (volume > 0)
    z, y, x = places[:, own]
    return {"label": found[own], "z": z, "y": y, "x": x, "count": np.ones(int(own.sum()), np.int64), "volume": volume[own], "sum_intensity": total[own]}


def cells(core: np.ndarray, overlap: np.ndarray, maxima: np.ndarray, mask: np.ndarray, depth: int) -> dict[str, np.ndarray]:
    """Cells of a block with a halo of ``depth``: one for each maximum in its core.

    A cell sits at its maximum's first voxel and measures what the watershed gives it,
    in the halo too.
    """
    inside = tuple(slice(depth, n - depth) for n in overlap.shape)
    if core.shape != overlap[inside].shape:
        raise ValueError("the core is not the block without its halo")
    labels = label(maxima[inside])
    padded = np.pad(labels, depth)
    grown = watershed(overlap, padded, mask)
    n = int(labels.max(initial=0))
    found, first = np.unique(labels.ravel(), return_index=True)
    first = first[found > 0]
    z, y, x = np.unravel_index(first, core.shape)
    volume = np.bincount(grown.ravel(), minlength=n + 1)[1 : n + 1]
    total = np.bincount(grown.ravel(), weights=overlap.ravel().astype(np.float64), minlength=n + 1)[1 : n + 1]
    return {"label": np.arange(1, n + 1), "z": z, "y": y, "x": x, "count": np.ones(n, np.int64), "volume": volume, "sum_intensity": total}
