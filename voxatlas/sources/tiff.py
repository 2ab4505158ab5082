"""Grey-scale TIFF images, BigTIFF too, as blocks of bytes and as voxel tables.

Images in strips or tiles, uncompressed, deflated, LZW or PackBits, with or without
horizontal differencing.  A file's z is its place among the names in natural order, or
its page for one file of many pages.

In folders that all executors have mounted a data source reads them: each of its
partitions is a slab, some planes of one row of blocks, of which a task opens only the
strips that it needs; a box of bounds on the places of the blocks' parts leaves out the
slabs beyond it before any file is opened.  What tasks send on is the part of each block
that lies in their slab, as bytes; no voxel becomes a row.  In a store that only Spark reads
a file passes through one task, which Spark refuses above 2 GB.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from voxatlas.functions.scalar import natural_key
from voxatlas.operators import chunks as B

#: Tags of the format, the sizes of its field types, and its ways to compress.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 317, 339
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
TAGS = {WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR, FORMAT, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS}
SIZES = {1: ("B", 1), 3: ("H", 2), 4: ("I", 4), 16: ("Q", 8)}
KINDS = {1: "u", 2: "i", 3: "f"}
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
DIFFERENCES = 2
#: Bytes of image that a slab has, about.
SLAB_BYTES = 32 << 20


# ---- the format ---------------------------------------------------------------------


def unpack_bits(data: bytes) -> bytes:
    """PackBits: runs of bytes, literal or repeated."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 2 if n > 128 else 1
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """LZW as in TIFF: codes of 9 to 12 bits, the highest bit first, widened one code early."""
    clear, end = 256, 257
    table: list[bytes] = []
    out: list[bytes] = []
    width, held, bits, last = 9, 0, 0, b""
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == end:
            break
        if code == clear:
            table = [bytes((k,)) for k in range(256)] + [b"", b""]
            width, last = 9, b""
            continue
        if not table:
            raise ValueError("LZW data that does not begin with a clear code")
        if code < len(table):
            entry = table[code]
        elif last and code == len(table):
            entry = last + last[:1]
        else:
            raise ValueError("broken LZW data")
        out.append(entry)
        if last:
            table.append(last + entry[:1])
        last = entry
        if len(table) + 1 >= 1 << width and width < 12:
            width += 1
    return b"".join(out)


def _decoded(data: bytes, compression: int) -> bytes:
    if compression == PLAIN:
        return data
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    return unpack_lzw(data) if compression == LZW else unpack_bits(data)


@dataclass
class Page:
    """What the directory says of an image: its type and shape, how it is cut into tiles (a strip is as
    wide as the image), and where they are, in order.
    """

    dtype: str
    height: int
    width: int
    offsets: np.ndarray
    counts: np.ndarray
    tile: tuple[int, int]
    compression: int = PLAIN
    predictor: int = 1

    def rows(self, file: BinaryIO, low: int, high: int) -> np.ndarray:
        """The image's rows from ``low`` to ``high``; only tiles that have some of them are read."""
        kind = np.dtype(self.dtype)
        h, w = self.tile
        across = -(-self.width // w)
        out = np.empty((high - low, self.width), kind)
        for down in range(low // h, -(-high // h)):
            top = down * h
            tall = h if w != self.width else min(h, self.height - top)  # the last strip has the rows that are left
            begin, stop = max(low, top), min(high, top + tall)
            for k in range(across):
                left = k * w
                n = min(w, self.width - left)
                at, count = int(self.offsets[down * across + k]), int(self.counts[down * across + k])
                if self.compression == PLAIN:
                    skip, size = (begin - top) * w * kind.itemsize, (stop - begin) * w * kind.itemsize
                    file.seek(at + skip)
                    part = np.frombuffer(file.read(size), kind).reshape(-1, w)
                else:
                    file.seek(at)
                    part = np.frombuffer(_decoded(file.read(count), self.compression)[: tall * w * kind.itemsize], kind).reshape(tall, w)[begin - top : stop - top]
                if self.predictor == DIFFERENCES:
                    part = np.cumsum(part, axis=1, dtype=kind.newbyteorder("=")).astype(kind)
                out[begin - low : stop - low, left : left + n] = part[:, :n]
        return out


def directory(file: BinaryIO) -> Iterator[Page]:
    """The pages of a TIFF or BigTIFF file; no image is read."""
    head = file.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack(order + "H", head[2:4])[0] if order and len(head) >= 8 else None
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    # codes of a place and of a number of entries, and the bytes that an entry has for values
    place, number, room = ("I", "H", 4) if version == 42 else ("Q", "Q", 8)

    def values(code: str, at: int, count: int = 1) -> tuple[int, ...]:
        file.seek(at)
        return struct.unpack(f"{order}{count}{code}", file.read(struct.calcsize(f"{order}{count}{code}")))

    (at,) = struct.unpack_from(order + place, head, room)
    while at:
        (n,) = values(number, at)
        at += struct.calcsize("=" + number)
        size = 4 + 2 * room
        file.seek(at)
        entries = file.read(n * size)
        tags = {}
        for k in range(n):
            tag, kind, count = struct.unpack_from(order + "HH" + place, entries, k * size)
            if kind in SIZES and tag in TAGS:
                code, bytes_ = SIZES[kind]
                here = at + k * size + 4 + room
                tags[tag] = values(code, values(place, here)[0] if count * bytes_ > room else here, count)
        yield _page(tags, order)
        (at,) = values(place, at + n * size)


def _page(tags: dict[int, tuple[int, ...]], order: str) -> Page:
    one = lambda tag, default: tags.get(tag, (default,))[0]
    compression, predictor = one(COMPRESSION, PLAIN), one(PREDICTOR, 1)
    if one(SAMPLES, 1) != 1 or len(tags.get(BITS, (1,))) != 1 or one(BITS, 1) not in (8, 16, 32, 64):
        raise ValueError("only grey-scale images of whole bytes are read")
    if compression not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS) or predictor not in (1, DIFFERENCES):
        raise ValueError(f"images compressed by way {compression} with predictor {predictor} are not read")
    dtype = f"{order}{KINDS[one(FORMAT, 1)]}{one(BITS, 8) // 8}"
    height, width = one(HEIGHT, 0), one(WIDTH, 0)
    tiled = TILE_OFFSETS in tags
    if not tiled and OFFSETS not in tags:
        raise ValueError("an image without strips or tiles")
    tile = (one(TILE_HEIGHT, 0), one(TILE_WIDTH, 0)) if tiled else (min(one(ROWS, height), height), width)
    offsets, counts = (np.array(tags[t], np.int64) for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS)))
    itemsize = np.dtype(dtype).itemsize
    if not tiled and ROWS not in tags and compression == PLAIN and len(counts) > 1:  # the strips themselves say how tall they are
        tile = (int(counts[0]) // max(1, width * itemsize), width)
    page = Page(dtype, height, width, offsets, counts, tile, compression, predictor)
    wanted = -(-height // tile[0]) * -(-width // tile[1]) if all(tile) else 0
    if len(offsets) != wanted or compression == PLAIN and counts.sum() < height * width * itemsize:
        raise ValueError("the strips of a page do not have the bytes of its image")
    return page


def pages(data: bytes) -> Iterator[np.ndarray]:
    """The images of a TIFF file."""
    file = io.BytesIO(data)
    for page in list(directory(file)):
        yield page.rows(file, 0, page.height)


def encode(images: list[np.ndarray]) -> bytes:
    """A TIFF file of such images."""
    out, links = bytearray(b"II*\0\0\0\0\0"), [4]
    for image in images:
        image = np.ascontiguousarray(image, image.dtype.newbyteorder("<"))
        data = len(out)
        out += image.tobytes()
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, links[-1], len(out))
        kind = {v: k for k, v in KINDS.items()}[image.dtype.kind]
        fields = [(WIDTH, image.shape[1]), (HEIGHT, image.shape[0]), (BITS, image.dtype.itemsize * 8), (COMPRESSION, PLAIN), (262, 1), (OFFSETS, data), (SAMPLES, 1), (ROWS, image.shape[0]), (COUNTS, image.nbytes), (FORMAT, kind)]
        out += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", tag, 4, 1, value) for tag, value in fields)
        links.append(len(out))
        out += b"\0\0\0\0"
    return bytes(out)


# ---- blocks -------------------------------------------------------------------------

#: The columns of a part of a block: those of a chunk table, whose place is the part's, and its last voxels.
PARTS_SCHEMA = B.SCHEMA + ", z1 bigint, y1 bigint, x1 bigint"


def block_parts(image: np.ndarray, start: tuple[int, int, int], chunk: B.Shape) -> Iterator[dict]:
    """The parts of blocks that a box of voxels has; it lies within one row of blocks along z and y."""
    key = [s // c for s, c in zip(start, chunk, strict=True)]
    for x in range(0, image.shape[2], chunk[2]):
        part = image[:, :, x : x + chunk[2]]
        place = dict(zip(B.KEY + B.PLACE, [key[0], key[1], key[2] + x // chunk[2], start[0], start[1], start[2] + x, *part.shape], strict=True))
        ends = {f"{a}1": place[f"{a}0"] + n - 1 for a, n in zip(B.AXES, part.shape, strict=True)}
        yield B.block_row(place, part.astype(part.dtype.newbyteorder("<")), 0) | ends


@dataclass
class Slab(InputPartition):
    """Some planes (z, file, page of it) of a row of blocks, from row ``low`` to ``high``."""

    planes: list[tuple[int, str, int]]
    low: int
    high: int

    def __init__(self, planes: list[tuple[int, str, int]], low: int, high: int):
        self.planes, self.low, self.high = planes, low, high


def natural(name: str) -> list:
    return [int(t) if t.isdigit() else t for t in re.split(r"(\d+)", name)]


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.pattern = options["path"], options.get("pattern", r"\.tiff?$")
        self.chunk = tuple(int(n) for n in options["chunk"].split(","))
        self.bytes = int(options.get("slab_bytes", SLAB_BYTES))
        #: least and greatest place that a part's first and last voxel must have
        self.bounds: dict[str, tuple[float, float]] = {}

    def _files(self) -> list[str]:
        if os.path.isfile(self.path):
            return [self.path]
        return sorted((os.path.join(self.path, n) for n in os.listdir(self.path) if re.search(self.pattern, n)), key=natural)

    def partitions(self) -> list[Slab]:
        files = self._files()
        if not files:
            return [Slab([], 0, 0)]
        with open(files[0], "rb") as file:
            found = list(directory(file))
        first = found[0]
        planes = [(k, files[0], k) for k in range(len(found))]
        for name in files[1:]:
            many = 1
            if len(found) > 1:  # files of several pages: each says how many
                with open(name, "rb") as file:
                    many = sum(1 for _ in directory(file))
            planes += [(planes[-1][0] + 1 + k, name, k) for k in range(many)]
        cz, cy, _ = self.chunk
        row = first.width * np.dtype(first.dtype).itemsize
        deep = max(1, self.bytes // max(1, min(cy, first.height) * row))
        slabs = []
        for z in range(0, len(planes), cz):
            for a in range(z, min(z + cz, len(planes)), deep):
                own = planes[a : min(a + deep, z + cz, len(planes))]
                for y in range(0, first.height, cy):
                    slabs.append(Slab(own, y, min(y + cy, first.height)))
        return [s for s in (self._cut(s) for s in slabs) if s.planes] or [Slab([], 0, 0)]

    def _cut(self, slab: Slab) -> Slab:
        """The slab without planes and rows that no wanted part has."""
        low, high = (lambda a: max(self.bounds.get(f"{a}1", (-np.inf, 0))[0], self.bounds.get(f"{a}0", (-np.inf, 0))[0])), (lambda a: min(self.bounds.get(f"{a}0", (0, np.inf))[1], self.bounds.get(f"{a}1", (0, np.inf))[1]))
        # bounds on first voxels from below and on last ones from above hold for whole parts, which stay as they are
        if "z0" in self.bounds and np.isfinite(self.bounds["z0"][0]) or "z1" in self.bounds and np.isfinite(self.bounds["z1"][1]):
            planes = slab.planes
        else:
            planes = [p for p in slab.planes if low("z") <= p[0] <= high("z")]
        if not low("y") <= slab.high - 1 or not slab.low <= high("y"):
            planes = []
        return Slab(planes, slab.low, slab.high)

    def read(self, slab: Slab) -> Iterator[pa.RecordBatch]:
        if not slab.planes:
            return
        parts, name, found, file = [], None, [], None
        try:
            for _, path, page in slab.planes:
                if path != name:
                    if file:
                        file.close()
                    file, name = open(path, "rb"), path  # noqa: SIM115 - closed below
                    found = list(directory(file))
                parts.append(found[page].rows(file, slab.low, slab.high))
        finally:
            if file:
                file.close()
        if len({p.shape[1] for p in parts}) > 1 or len({p.dtype for p in parts}) > 1:
            raise ValueError(f"the images of {self.path} do not all have one shape and type")
        for part in block_parts(np.stack(parts), (slab.planes[0][0], slab.low, 0), self.chunk):
            yield pa.RecordBatch.from_pylist([part], schema=_PARTS)


_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_PARTS = pa.schema([(f.split()[0], _TYPES[f.split()[1]]) for f in PARTS_SCHEMA.split(", ")])


class _PushedReader(_Reader):
    """A reader that takes bounds of places from the query's filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = getattr(f, "attribute", ("",))[0]
            if name in ("z0", "z1", "y0", "y1") and isinstance(f, (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low, high = self.bounds.get(name, (-np.inf, np.inf))
                if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    low = max(low, f.value + isinstance(f, GreaterThan))
                else:
                    high = min(high, f.value - isinstance(f, LessThan))
                self.bounds[name] = (low, high)
            yield f  # slabs beyond the bounds are not read; Spark looks at the rest


class TiffBlocks(DataSource):
    """Parts of blocks of a folder of slices or a file of pages: options path, chunk (z,y,x) and pattern."""

    @classmethod
    def name(cls) -> str:
        return "tiff_blocks"

    def schema(self) -> str:
        return PARTS_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return (_PushedReader if self.options.get("push") == "true" else _Reader)(dict(self.options))


def _local(path: str) -> str | None:
    """The name that a file of a mounted folder has for open(); None for files of other stores."""
    if "://" not in path and not path.startswith("file:"):
        return path
    return path[5:].replace("///", "/", 1) if path.startswith("file:") else None


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The path as open() takes it, if it is in a mounted folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return _local(target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString())


def parts(spark: SparkSession, path: str, chunk: B.Shape, pattern: str = r"\.tiff?$") -> DataFrame:
    """Parts of blocks (``PARTS_SCHEMA``) of a folder of slices, or of one file of many pages.

    Filters on z0, z1, y0 and y1 keep files and strips closed where Spark is allowed to
    push them (spark.sql.python.filterPushdown.enabled).
    """
    mounted = _mounted(spark, path)
    if mounted is not None:
        spark.dataSource.register(TiffBlocks)
        push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
        return spark.read.format("tiff_blocks").options(path=mounted, pattern=pattern, chunk=",".join(map(str, chunk)), slab_bytes=SLAB_BYTES, push=push).load()
    files = spark.read.format("binaryFile").load(path).where(F.regexp_like("path", F.lit(pattern)))
    names = files.select("path", natural_key("path").alias("key")).orderBy("key").select("path").collect()
    first = {r["path"]: k for k, r in enumerate(names)}

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[dict]:
            for frame in frames:
                for name, content in zip(frame["path"], frame["content"], strict=True):
                    file = io.BytesIO(content)
                    for number, page in enumerate(list(directory(file))):
                        for low in range(0, page.height, chunk[1]):
                            yield from block_parts(page.rows(file, low, min(low + chunk[1], page.height))[None], (first[name] + number, low, 0), chunk)

        return B.frames_of(found(), ("z1", "y1", "x1"))

    return files.select("path", "content").mapInPandas(split, PARTS_SCHEMA)


def assemble(found: DataFrame, chunk: B.Shape) -> DataFrame:
    """Chunks from their parts; a task holds one chunk and its parts."""

    def gather(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        start = [int(k) * c for k, c in zip(key, chunk, strict=True)]
        size = [int((rows[f"{a}1"].max()) + 1 - s) for a, s in zip(B.AXES, start, strict=True)]
        array = np.zeros(size, np.dtype(rows["dtype"].iloc[0]))
        for row in rows.to_dict("records"):
            part = B.block(row)
            array[tuple(slice(int(row[f"{a}0"]) - s, int(row[f"{a}0"]) - s + n) for a, s, n in zip(B.AXES, start, part.shape, strict=True))] = part
        return B.frame([B.block_row(dict(zip(B.KEY + B.PLACE, [*key, *start, *size], strict=True)), array, 0)])

    return found.groupBy(*B.KEY).applyInPandas(gather, B.SCHEMA)


def read_blocks(spark: SparkSession, path: str, chunk: B.Shape, pattern: str = r"\.tiff?$") -> DataFrame:
    """The chunk table of a folder of slices, or of one file of many pages."""
    return assemble(parts(spark, path, chunk, pattern), chunk)


def read_stack(spark: SparkSession, path: str, pattern: str = r"\.tiff?$", rows: int = 512) -> DataFrame:
    """Voxels (z, y, x, v) of a folder of slices, or of one file of many pages."""
    return B.to_voxels(parts(spark, path, (1, rows, 1 << 20), pattern))


# ---- files out ----------------------------------------------------------------------


def slice_files(voxels: DataFrame, dtype: str = "<u2") -> DataFrame:
    """(z, content): a TIFF file for each plane of a dense volume."""

    def plane(part: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((part["y"].max() + 1, part["x"].max() + 1), np.dtype(dtype))
        image[part["y"], part["x"]] = part["v"]
        return pd.DataFrame({"z": [part["z"].iloc[0]], "content": [encode([image])]})

    return voxels.groupBy("z").applyInPandas(plane, "z int, content binary")


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]


class _FilesWriter(DataSourceWriter):
    """Files (name, content) of a mounted folder: written aside by the tasks, moved there by the commit.

    With ``joined`` they become one file, in the order of their names.
    """

    def __init__(self, path: str, joined: str | None, overwrite: bool):
        self.path, self.joined, self.overwrite = path, joined, overwrite
        self.aside = os.path.join(path if joined is None else os.path.dirname(path) or ".", f"_temporary-{uuid.uuid4().hex}")

    def write(self, rows) -> _Written:
        own = os.path.join(self.aside, uuid.uuid4().hex)  # an attempt's own folder
        os.makedirs(own)
        names = []
        for row in rows:
            names.append(os.path.join(own, row["name"]))
            with open(names[-1], "wb") as file:
                file.write(row["content"])
        return _Written(names)

    def commit(self, messages) -> None:
        names = sorted((n for m in messages if m for n in m.names), key=lambda n: natural(os.path.basename(n)))
        if self.joined is None:
            for name in names:
                os.replace(name, os.path.join(self.path, os.path.basename(name)))
        else:
            whole = os.path.join(self.aside, "whole")
            os.makedirs(self.aside, exist_ok=True)
            with open(whole, "wb") as out:
                for name in names:
                    with open(name, "rb") as file:
                        while data := file.read(1 << 20):
                            out.write(data)
            os.replace(whole, self.path)
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        for folder, _, names in os.walk(self.aside, topdown=False):
            for name in names:
                os.remove(os.path.join(folder, name))
            os.rmdir(folder)


class ImageFiles(DataSource):
    """Files of a mounted folder from rows (name, content), or with option joined one file of them all."""

    @classmethod
    def name(cls) -> str:
        return "image_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        path = self.options["path"]
        joined = self.options.get("joined") == "true"
        os.makedirs(os.path.dirname(path) or "." if joined else path, exist_ok=True)
        return _FilesWriter(path, path if joined else None, overwrite)


def write_files(files: DataFrame, path: str, joined: bool = False) -> None:
    """Rows (name, content) as files of a folder, or as one file; nothing is there before all are written."""
    spark = files.sparkSession
    mounted = _mounted(spark, path)
    if mounted is None:
        raise ValueError(f"{path} is not in a mounted folder; write the rows as a table there")
    spark.dataSource.register(ImageFiles)
    files.select("name", "content").write.format("image_files").options(path=mounted, joined=str(joined).lower()).mode("append").save()


def write_tiffs(chunks: DataFrame, path: str, sizes: B.Shape) -> None:
    """A chunk table as a folder of TIFF files, one for each plane, assembled from the blocks' planes."""
    ny, nx = sizes[1:]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def found() -> Iterator[dict]:
            for row in B.records(frames):
                core = B.core(row)
                for z in range(len(core)):
                    place = dict(zip(B.KEY + B.PLACE, [0, 0, 0, int(row["z0"]) + z, int(row["y0"]), int(row["x0"]), 1, *core.shape[1:]], strict=True))
                    yield B.block_row(place, core[z][None], 0)

        return B.frames_of(found())

    def plane(rows: pd.DataFrame) -> pd.DataFrame:
        image = np.zeros((ny, nx), np.dtype(rows["dtype"].iloc[0]))
        for row in rows.to_dict("records"):
            image[int(row["y0"]) : int(row["y0"]) + int(row["ny"]), int(row["x0"]) : int(row["x0"]) + int(row["nx"])] = B.block(row)[0]
        return pd.DataFrame({"name": [f"slice_{int(rows['z0'].iloc[0]):04d}.tif"], "content": [encode([image])]})

    write_files(chunks.mapInPandas(cut, B.SCHEMA).groupBy("z0").applyInPandas(plane, "name string, content binary"), path)
