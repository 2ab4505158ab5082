"""Volumes as chunk tables: one row and one binary payload for each block of a grid.

Columns: chunk_z, chunk_y, chunk_x; z0, y0, x0 (first voxel of the core); nz, ny, nx
(core sizes); halo; dtype; payload (C order, halo included).  First voxels are plain
columns, so that a box filter prunes files by their statistics.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AXES = ("z", "y", "x")
KEY = ["chunk_z", "chunk_y", "chunk_x"]
PLACE = ["z0", "y0", "x0", "nz", "ny", "nx"]
SCHEMA = "chunk_z int, chunk_y int, chunk_x int, z0 bigint, y0 bigint, x0 bigint, nz int, ny int, nx int, halo int, dtype string, payload binary"
Shape = tuple[int, int, int]
#: The type of a mask whose voxels have one bit each.
BITS = "bits"


def block(row, payload: str = "payload", dtype: str = "dtype", halo: str = "halo") -> np.ndarray:
    """The array of a row."""
    h = 2 * int(row[halo])
    shape = tuple(int(row[n]) + h for n in PLACE[3:])
    if row[dtype] == BITS:
        return np.unpackbits(np.frombuffer(row[payload], np.uint8), count=shape[0] * shape[1] * shape[2]).reshape(shape).view(bool)
    return np.frombuffer(row[payload], np.dtype(row[dtype])).reshape(shape)


def core(row, payload: str = "payload", dtype: str = "dtype", halo: str = "halo") -> np.ndarray:
    """The array of a row without its halo."""
    h = int(row[halo])
    return block(row, payload, dtype, halo)[tuple(slice(h, h + int(row[n])) for n in PLACE[3:])]


def block_row(like, array: np.ndarray, halo: int) -> dict:
    """The row of an array at the place of another row."""
    return {k: like[k] for k in KEY + PLACE} | {"halo": halo, "dtype": array.dtype.str, "payload": np.ascontiguousarray(array).tobytes()}


def frame(rows: list[dict]) -> pd.DataFrame:
    """Rows of a chunk table."""
    return pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


#: Voxels that become rows at once.
SPREAD = 1 << 18
#: Bytes that go into one frame, blocks that are larger by themselves, and what a row takes besides its payload.
FRAME_BYTES, ROW_BYTES = 4 << 20, 2 << 10


def frames_of(rows: Iterator[dict], more: tuple[str, ...] = ()) -> Iterator[pd.DataFrame]:
    """Rows of a chunk table, with other columns ``more``, some at a time."""
    held, size = [], 0
    columns = [*(c.split()[0] for c in SCHEMA.split(", ")), *more]
    for row in rows:
        own = len(row["payload"]) + ROW_BYTES
        if held and size + own > FRAME_BYTES:
            yield pd.DataFrame(held, columns=columns)
            held, size = [], 0
        held.append(row)
        size += own
    if held:
        yield pd.DataFrame(held, columns=columns)


def records(frames: Iterator[pd.DataFrame]) -> Iterator[dict]:
    """The rows of some frames, one after the other."""
    for part in frames:
        names = list(part.columns)
        for values in part.itertuples(index=False, name=None):
            yield dict(zip(names, values, strict=True))


def from_voxels(voxels: DataFrame, sizes: Shape, chunk: Shape = (64, 64, 64), dtype: str = "<u2") -> DataFrame:
    """Voxels (z, y, x, v) gathered into chunks; voxels that are missing are 0."""
    keyed = voxels.select(*(F.expr(f"cast({a} div {c} as int)").alias(k) for a, c, k in zip(AXES, chunk, KEY, strict=True)), *AXES, "v")

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        start = [int(k) * c for k, c in zip(key, chunk, strict=True)]
        size = [min(c, n - s) for c, n, s in zip(chunk, sizes, start, strict=True)]
        array = np.zeros(size, np.dtype(dtype))
        array[tuple(part[a].to_numpy() - s for a, s in zip(AXES, start, strict=True))] = part["v"].to_numpy()
        return frame([block_row(dict(zip(KEY + PLACE, [*key, *start, *size], strict=True)), array, 0)])

    return keyed.groupBy(*KEY).applyInPandas(gather, SCHEMA)


def presence(voxels: DataFrame, sizes: Shape, chunk: Shape = (64, 64, 64)) -> DataFrame | None:
    """Chunks of 1 where a volume has a voxel; none if it has all."""
    if voxels.count() == sizes[0] * sizes[1] * sizes[2]:
        return None
    return from_voxels(voxels.withColumn("v", F.lit(1)), sizes, chunk, "u1")


def _spread(chunks: DataFrame, zeros: bool, kind: str, dtype: type) -> DataFrame:
    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in records(frames):
            array = core(row)
            step = max(1, SPREAD // max(1, array[0].size))
            for z in range(0, len(array), step):  # some planes at a time
                planes = array[z : z + step]
                at = np.indices(planes.shape, np.int32).reshape(3, -1)
                v = planes.ravel()
                if not zeros:
                    at, v = at[:, v != 0], v[v != 0]
                yield pd.DataFrame({a: at[k] + np.int32(row[f"{a}0"] + (z if k == 0 else 0)) for k, a in enumerate(AXES)} | {"v": v.astype(dtype)})

    return chunks.mapInPandas(spread, f"z int, y int, x int, v {kind}")


def to_voxels(chunks: DataFrame, zeros: bool = True) -> DataFrame:
    """The core voxels of each chunk, as whole numbers."""
    return _spread(chunks, zeros, "bigint", np.int64)


def to_values(chunks: DataFrame) -> DataFrame:
    """The core voxels of each chunk, as doubles."""
    return _spread(chunks, True, "double", np.float64)


def as_bits(chunks: DataFrame) -> DataFrame:
    """Where the blocks are not 0, a bit a voxel: an eighth or less of what a mask has otherwise."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames_of({k: row[k] for k in KEY + PLACE} | {"halo": int(row["halo"]), "dtype": BITS, "payload": np.packbits(block(row).ravel() != 0).tobytes()} for row in records(frames))

    return chunks.mapInPandas(run, SCHEMA)


def map_blocks(chunks: DataFrame, f: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``f`` of every block, halo included; the shape stays."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames_of(block_row(row, f(block(row)), int(row["halo"])) for row in records(frames))

    return chunks.mapInPandas(run, SCHEMA)


def add_halo(chunks: DataFrame, sizes: Shape, chunk: Shape, depth: int, mode: str = "symmetric") -> DataFrame:
    """Every block with ``depth`` voxels of its neighbours around it, mirrored at the volume's borders:
    the end voxels included, or with ``mode`` "reflect" about their centres.

    Each block sends to every block the part of itself that lies in the other's halo,
    so that a halo voxel crosses the network once.
    """
    return chunks if depth == 0 else _with_halo(chunks, sizes, chunk, depth, mode, lambda row: frame([row]), SCHEMA)


def halo_to_table(chunks: DataFrame, sizes: Shape, chunk: Shape, depth: int, f: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str, mode: str = "symmetric") -> DataFrame:
    """Rows that ``f`` makes of each block with its halo, as in ``blocks_to_table``.

    The block goes to ``f`` where it is put together, so that a task holds one at a time,
    and no batch of them, and needs no second Python worker.
    """
    if depth == 0:
        return blocks_to_table(zip_blocks({"halo": chunks}), ["halo"], f, schema)
    return _with_halo(chunks, sizes, chunk, depth, mode, lambda row: _placed(row, f(block(row))), KEYED + schema)


def _with_halo(chunks: DataFrame, sizes: Shape, chunk: Shape, depth: int, mode: str, f: Callable[[dict], pd.DataFrame], schema: str) -> DataFrame:
    """What ``f`` makes of the row of each block with its halo."""

    def parts_of(row: dict) -> Iterator[dict]:
        array = block(row)
        low = [int(row[f"{a}0"]) for a in AXES]
        high = [s + n for s, n in zip(low, array.shape, strict=True)]
        reach = [range(max(0, (s - depth) // c), min(-(-n // c), (e + depth - 1) // c + 1)) for s, e, c, n in zip(low, high, chunk, sizes, strict=True)]
        for to in ((a, b, c) for a in reach[0] for b in reach[1] for c in reach[2]):
            start = [t * c for t, c in zip(to, chunk, strict=True)]
            stop = [min(s + c, n) for s, c, n in zip(start, chunk, sizes, strict=True)]
            box = [(max(s - depth, p), min(e + depth, q)) for s, e, p, q in zip(start, stop, low, high, strict=True)]
            if all(p < q for p, q in box):
                part = array[tuple(slice(p - s, q - s) for (p, q), s in zip(box, low, strict=True))]
                place = dict(zip(KEY + PLACE, [*to, *(p for p, _ in box), *part.shape], strict=True))
                yield block_row(place, part, 0)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames_of(part for row in records(frames) for part in parts_of(row))

    def assemble(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        start = [int(k) * c for k, c in zip(key, chunk, strict=True)]
        size = [min(c, n - s) for c, n, s in zip(chunk, sizes, start, strict=True)]
        low = [max(0, s - depth) for s in start]
        high = [min(n, s + k + depth) for n, s, k in zip(sizes, start, size, strict=True)]
        array = np.zeros([e - s for s, e in zip(low, high, strict=True)], np.dtype(parts["dtype"].iloc[0]))
        for row in parts.to_dict("records"):
            part = block(row)
            array[tuple(slice(int(row[f"{a}0"]) - s, int(row[f"{a}0"]) - s + n) for a, s, n in zip(AXES, low, part.shape, strict=True))] = part
        pad = [(depth - (s - l), depth - (h - s - k)) for s, l, h, k in zip(start, low, high, size, strict=True)]
        array = np.pad(array, pad, mode=mode)
        return f(block_row(dict(zip(KEY + PLACE, [*key, *start, *size], strict=True)), array, depth))

    return chunks.mapInPandas(send, SCHEMA).groupBy(*KEY).applyInPandas(assemble, schema)


def trim_halo(chunks: DataFrame) -> DataFrame:
    """Every block without its halo."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames_of(block_row(row, core(row), 0) for row in records(frames))

    return chunks.mapInPandas(cut, SCHEMA)


def to_block(points: DataFrame, chunks: DataFrame) -> DataFrame:
    """Points of chunks (``KEY`` and z, y, x in the whole volume) with places from their chunk's first voxel."""
    origins = chunks.select(*KEY, *(F.col(f"{a}0").alias(f"_{a}0") for a in AXES))
    return points.join(origins, KEY).withColumns({a: F.col(a) - F.col(f"_{a}0") for a in AXES}).drop(*(f"_{a}0" for a in AXES))


def zip_blocks(chunks: dict[str, DataFrame]) -> DataFrame:
    """Chunk tables of one grid side by side: <name>_payload, _dtype and _halo for each.

    A row has the bytes of all its blocks, of which Spark holds 2 GB at most: masks go
    ``as_bits``.
    """
    out = None
    for name, df in chunks.items():
        one = df.select(*KEY, *(PLACE if out is None else []), *(F.col(c).alias(f"{name}_{c}") for c in ("payload", "dtype", "halo")))
        out = one if out is None else out.join(one, KEY)
    return out


#: The columns of a block's key, before others.
KEYED = "chunk_z int, chunk_y int, chunk_x int, "


def _placed(row: dict, found: dict[str, np.ndarray]) -> pd.DataFrame:
    """What was found in the block of a row, with its key, and z, y and x moved to the whole volume."""
    out = pd.DataFrame(found)
    for a in AXES:
        out[a] = out[a] + int(row[f"{a}0"])
    for k in KEY:
        out[k] = row[k]
    return out


def blocks_to_table(zipped: DataFrame, names: list[str], f: Callable[..., dict[str, np.ndarray]], schema: str) -> DataFrame:
    """Rows that ``f`` makes of each place's blocks, with z, y and x moved to the whole volume.

    The chunk's key goes along, as labels are told apart only within a chunk.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in records(frames):
            yield _placed(row, f(*(block(row, f"{n}_payload", f"{n}_dtype", f"{n}_halo") for n in names)))

    return zipped.mapInPandas(run, KEYED + schema)
