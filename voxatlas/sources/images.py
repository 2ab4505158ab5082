"""Images by their format: a reader with a box, a writer of slices, NIfTI, and raw arrays' headers."""

from __future__ import annotations

import ast
import gzip
import io
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.operators import voxels as V
from voxatlas.operators.chunks import to_voxels
from voxatlas.sources import tiff

#: NIfTI codes of value types; element types of raw array headers.
NIFTI_TYPES = {"u1": 2, "i2": 4, "i4": 8, "f4": 16, "f8": 64, "i1": 256, "u2": 512, "u4": 768}
ELEMENT_TYPES = {"i1": "MET_CHAR", "u1": "MET_UCHAR", "i2": "MET_SHORT", "u2": "MET_USHORT", "i4": "MET_INT", "u4": "MET_UINT", "f4": "MET_FLOAT", "f8": "MET_DOUBLE"}
NIFTI_HEADER, NIFTI_DATA = 348, 352
#: Fixed value: how a gzip member begins.
MAGIC = b"\x1f\x8b\x08"
#: Bytes of a compressed file that a task looks for members in, and voxels that become rows at once.
MEMBER_STEP, PLANE = 32 << 20, 1 << 18
VOXELS = "z int, y int, x int, v double"


def read_image(spark: SparkSession, path: str, box: tuple[V.Slice, V.Slice, V.Slice] | None = None) -> DataFrame:
    """Voxels (z, y, x, v) of a TIFF file or folder, a NIfTI file, or a chunk table, trimmed to a box.

    Of a chunk table only the chunks that meet a box of plain bounds are read.
    """
    name = path.rstrip("/").lower()
    if name.endswith((".tif", ".tiff", "/tiff", "/slices")):
        out = tiff.read_stack(spark, path)
    elif name.endswith((".nii", ".nii.gz")):
        out = read_nifti(spark, path)
    elif name.endswith((".parquet", "/chunks")):
        chunks = spark.read.parquet(path)
        for axis, (start, stop, step) in zip(V.AXES, box or (), strict=False):
            if (step or 1) > 0 and (start or 0) >= 0 and (stop is None or stop >= 0):
                chunks = chunks.where(F.col(f"{axis}0") + F.col(f"n{axis}") > (start or 0))
                chunks = chunks if stop is None else chunks.where(F.col(f"{axis}0") < stop)
        out = to_voxels(chunks)
    else:
        raise NotImplementedError(f"no reader for {path}")
    return V.trim(out, box) if box else out


def write_slices(image: DataFrame, path: str, dtype: str = "<u2") -> None:
    """A dense volume as a table (z, content) of TIFF files, one for each plane; ``tiff.write_tiffs`` writes files."""
    tiff.slice_files(image, dtype).write.mode("overwrite").parquet(path)


def _layout(header: bytes) -> tuple[np.dtype, tuple[int, int, int], int]:
    """The type of a NIfTI file's voxels, its sizes (the first axis lies closest), and where they begin."""
    order = "<" if struct.unpack_from("<i", header)[0] == NIFTI_HEADER else ">"
    dims = struct.unpack_from(order + "8h", header, 40)
    kinds = {v: k for k, v in NIFTI_TYPES.items()}
    dtype = np.dtype(order + kinds[struct.unpack_from(order + "h", header, 70)[0]])
    return dtype, tuple(dims[k] if k <= dims[0] else 1 for k in (1, 2, 3)), int(struct.unpack_from(order + "f", header, 108)[0])


def _member(file, at: int, most: int | None = None, keep: bool = True) -> tuple[bytes, int, int] | None:
    """The bytes of the gzip member at a place, its length and their number, or None if there is no whole one.

    With ``most`` its first bytes at least; without ``keep`` it is gone through, its bytes are not.
    """
    file.seek(at)
    stream, out, size = zlib.decompressobj(wbits=31), [], 0
    try:
        while not stream.eof and (most is None or size < most):
            data = file.read(1 << 16)
            if not data:
                return None if most is None else (b"".join(out), 0, size)
            data = stream.decompress(data)
            size += len(data)
            if keep:
                out.append(data)
    except zlib.error:
        return None
    return b"".join(out), file.tell() - at - len(stream.unused_data), size


def gzip_members(spark: SparkSession, path: str, size: int, step: int | None = None) -> list[tuple[int, int, int]]:
    """(place, length, bytes when unpacked) of a mounted file's gzip members, in order.

    The file is dealt out by ranges of bytes.  A task tries every place in its range that
    looks like a member's beginning: one is taken if its checksum holds, and if the one
    before it ends there.  So each member is unpacked once, by some task.
    """
    step = step or MEMBER_STEP

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"].tolist():
                with open(path, "rb") as file:
                    file.seek(k * step)
                    data = file.read(step + len(MAGIC) - 1)
                    at = data.find(MAGIC)
                    while at >= 0:
                        got = _member(file, k * step + at, keep=False)
                        if got:
                            yield pd.DataFrame({"at": [k * step + at], "length": [got[1]], "size": [got[2]]})
                        at = data.find(MAGIC, at + 1)

    found = {r["at"]: (r["length"], r["size"]) for r in spark.range(0, -(-size // step), 1, max(1, min(-(-size // step), 10_000))).mapInPandas(find, "at bigint, length bigint, size bigint").collect()}
    out, at = [], 0
    while at in found:
        out.append((at, *found[at]))
        at += found[at][0]
    return out


def read_nifti(spark: SparkSession, path: str) -> DataFrame:
    """Voxels of a NIfTI file; the first axis lies closest in it.

    In a mounted folder it may have any size: many tasks read a plain file, and a
    compressed one by its members, where it has several.  A file of one member, and files
    in a store that only Spark reads, which refuses them above 2 GB, are read by one task,
    plane by plane, as a compressed stream can only be read from its beginning.
    """
    mounted = tiff._mounted(spark, path)
    if mounted is None or not os.path.isfile(mounted):
        return spark.read.format("binaryFile").load(path).select("content").mapInPandas(lambda frames: (p for frame in frames for c in frame["content"] for p in _planes(io.BytesIO(c))), VOXELS)
    with open(mounted, "rb") as file:
        packed = file.read(2) == b"\x1f\x8b"
        head = b""
        at = 0
        while len(head) < NIFTI_DATA:
            if not packed:
                file.seek(0)
                head = file.read(NIFTI_DATA)
                break
            got = _member(file, at, NIFTI_DATA - len(head))
            if not got or not got[1]:
                break
            head, at = head + got[0], at + got[1]
    dtype, sizes, start = _layout(head)
    members = gzip_members(spark, mounted, os.path.getsize(mounted)) if packed else []
    if packed and len(members) < 2:
        one = spark.range(0, 1, 1, 1)
        return one.mapInPandas(lambda frames: (p for _ in frames for p in _planes(open(mounted, "rb"))), VOXELS)
    ends = np.cumsum([m[2] for m in members]).tolist()
    total = start + dtype.itemsize * int(np.prod(sizes))
    if packed and ends[-1] < total:
        raise ValueError(f"{path} ends before its last voxel")
    step = max(1, tiff.SLAB_BYTES // dtype.itemsize) * dtype.itemsize

    def unpacked(low: int, high: int) -> bytes:
        """Bytes of the file as it is unpacked."""
        with open(mounted, "rb") as file:
            if not packed:
                file.seek(low)
                return file.read(high - low)
            out, k = [], int(np.searchsorted(ends, low, side="right"))
            first = ends[k] - members[k][2]
            while k < len(members) and ends[k] - members[k][2] < high:
                out.append(_member(file, members[k][0])[0])
                k += 1
            return b"".join(out)[low - first : high - first]

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"].tolist():
                low = start + k * step
                values = np.frombuffer(unpacked(low, min(low + step, total)), dtype)
                number = np.arange(len(values), dtype=np.int64) + k * (step // dtype.itemsize)
                for at in range(0, len(values), PLANE):
                    x, y, z = np.unravel_index(number[at : at + PLANE], sizes[::-1])
                    yield pd.DataFrame({"z": z.astype(np.int32), "y": y.astype(np.int32), "x": x.astype(np.int32), "v": values[at : at + PLANE].astype(np.float64)})

    tasks = -(-(total - start) // step)
    return spark.range(0, tasks, 1, tasks).mapInPandas(decode, VOXELS)


def _planes(raw) -> Iterator[pd.DataFrame]:
    """Voxels of a file that is read from its beginning."""
    with raw:
        packed = raw.read(2) == b"\x1f\x8b"
        raw.seek(0)
        file = gzip.open(raw) if packed else raw
        dtype, (n, m, last), at = _layout(header := file.read(NIFTI_DATA))
        file.read(at - len(header))
        for x in range(last):
            plane = np.frombuffer(file.read(n * m * dtype.itemsize), dtype).reshape(m, n)
            y, z = np.indices(plane.shape).reshape(2, -1)
            yield pd.DataFrame({"z": z.astype(np.int32), "y": y.astype(np.int32), "x": np.int32(x), "v": plane.ravel().astype(np.float64)})


def nifti_header(sizes: tuple[int, int, int], dtype: str = "<u2") -> bytes:
    kind = np.dtype(dtype).newbyteorder("<")
    header = bytearray(NIFTI_DATA)
    struct.pack_into("<i", header, 0, NIFTI_HEADER)
    struct.pack_into("<8h", header, 40, 3, *sizes, 1, 1, 1, 1)
    struct.pack_into("<2h", header, 70, NIFTI_TYPES[kind.str[1:]], kind.itemsize * 8)
    struct.pack_into("<8f", header, 76, 1, 1, 1, 1, 1, 1, 1, 1)
    struct.pack_into("<3f", header, 108, NIFTI_DATA, 1, 0)
    header[344:348] = b"n+1\0"
    return bytes(header)


def nifti_members(image: DataFrame, sizes: tuple[int, int, int], dtype: str = "<u2") -> DataFrame:
    """(part, content): gzip members that make a NIfTI file if joined in order of part.

    The header is part 0; every plane of the last axis is compressed by its own task.
    """

    def plane(part: pd.DataFrame) -> pd.DataFrame:
        values = np.zeros((sizes[1], sizes[0]), np.dtype(dtype).newbyteorder("<"))
        values[part["y"], part["z"]] = part["v"]
        return pd.DataFrame({"part": [int(part["x"].iloc[0]) + 1], "content": [gzip.compress(values.tobytes(), mtime=0)]})

    spark = image.sparkSession
    head = spark.createDataFrame([(0, bytearray(gzip.compress(nifti_header(sizes, dtype), mtime=0)))], "part int, content binary")
    return head.unionByName(image.groupBy("x").applyInPandas(plane, "part int, content binary"))


def write_nifti(image: DataFrame, sizes: tuple[int, int, int], path: str, dtype: str = "<u2") -> None:
    """A dense volume as one compressed NIfTI file of a mounted folder: its members, written by their tasks and joined."""
    members = nifti_members(image, sizes, dtype).select(F.format_string("%09d", "part").alias("name"), "content")
    tiff.write_files(members, path, joined=True)


def npy_header(data: bytes) -> tuple[int, tuple[int, ...], np.dtype]:
    """(bytes of the header, shape, type) of a saved array."""
    if data[:6] != b"\x93NUMPY":
        raise ValueError("not a saved array")
    wide = data[6] > 1
    (size,) = struct.unpack_from("<I" if wide else "<H", data, 8)
    start = 12 if wide else 10
    fields = ast.literal_eval(data[start : start + size].decode("latin1"))
    return start + size, tuple(fields["shape"]), np.dtype(fields["descr"])


def mhd(data: bytes, name: str) -> str:
    """The text of a header that describes a saved array of three axes, in the file ``name``, in x y z order."""
    skip, shape, dtype = npy_header(data)
    fields = {
        "ObjectType": "Image",
        "NDims": len(shape),
        "DimSize": " ".join(map(str, reversed(shape))),
        "ElementType": ELEMENT_TYPES[dtype.str[1:]],
        "ElementByteOrderMSB": str(dtype.str[0] == ">"),
        "HeaderSize": skip,
        "ElementDataFile": name,
    }
    return "".join(f"{k} = {v}\n" for k, v in fields.items())
