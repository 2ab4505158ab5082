"""TIFF files in every way they are read, block by block; files out."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_registration import chunked, voxels, whole
from voxatlas.operators import chunks as B
from voxatlas.sources import images, tiff


def pack_bits(data):
    """Literal runs, and repeats where a byte comes three times."""
    out, at = bytearray(), 0
    while at < len(data):
        n = 1
        while n < 128 and at + n < len(data) and data[at + n] == data[at]:
            n += 1
        if n >= 3:
            out += bytes((257 - n, data[at]))
        else:
            n = min(2, len(data) - at)
            out += bytes((n - 1,)) + data[at : at + n]
        at += n
    return bytes(out)


def pack_lzw(data):
    """The codes of a plain encoder, clearing its table when it is full."""
    bits, width, table, prefix = "", 9, {bytes((k,)): k for k in range(256)}, b""
    codes = [(256, 9)]
    after = 258
    for k in range(len(data)):
        c = data[k : k + 1]
        if prefix + c in table:
            prefix += c
            continue
        codes.append((table[prefix], width))
        table[prefix + c] = after
        after += 1
        if after + 1 > 1 << width:
            width += 1
        if after >= 4094:
            codes.append((256, width if width < 13 else 12))
            table, after, width = {bytes((k,)): k for k in range(256)}, 258, 9
        prefix = c
    if prefix:
        codes.append((table[prefix], width))
        after += 1
        if after + 1 > 1 << width and width < 12:
            width += 1
    codes.append((257, width))
    bits = "".join(f"{code:0{w}b}" for code, w in codes)
    bits += "0" * (-len(bits) % 8)
    return bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))


CODERS = {1: bytes, 5: pack_lzw, 8: zlib.compress, 32946: zlib.compress, 32773: pack_bits}


def coded(images, compression, predictor=1, tile=None, strip=5, order="<"):
    """A TIFF file whose tiles or strips are compressed."""
    out, link = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0)), 4
    for image in images:
        image = image.astype(image.dtype.newbyteorder(order))
        h, w = tile or (strip, image.shape[1])
        pieces = []
        for y in range(0, image.shape[0], h):
            for x in range(0, image.shape[1], w):
                part = image[y : y + h, x : x + w]
                if tile:
                    part = np.pad(part, ((0, h - part.shape[0]), (0, w - part.shape[1])), mode="edge")
                if predictor == 2:
                    part = np.diff(part.astype(image.dtype.newbyteorder("=")), axis=1, prepend=part[:, :1] * 0).astype(image.dtype)
                pieces.append(CODERS[compression](part.tobytes()))
        offsets = []
        for p in pieces:
            offsets.append(len(out))
            out += p
        out += b"\0" * (len(out) % 2)
        lists = len(out)
        out += struct.pack(f"{order}{len(pieces)}I", *offsets) + struct.pack(f"{order}{len(pieces)}I", *map(len, pieces))
        struct.pack_into(order + "I", out, link, len(out))
        kind = {"u": 1, "i": 2, "f": 3}[image.dtype.kind]
        n = len(pieces)
        at = lambda here, values: here if n > 1 else values[0]  # noqa: B023, E731
        places, counts = (324, 325) if tile else (273, 279)
        fields = [(256, 1, image.shape[1]), (257, 1, image.shape[0]), (258, 1, image.dtype.itemsize * 8), (259, 1, compression), (places, n, at(lists, offsets)), (counts, n, at(lists + 4 * n, [len(p) for p in pieces])), (317, 1, predictor), (339, 1, kind)]
        fields += [(322, 1, w), (323, 1, h)] if tile else [(278, 1, h)]
        fields.sort()
        out += struct.pack(order + "H", len(fields)) + b"".join(struct.pack(order + "HHII", t, 4, c, v) for t, c, v in fields)
        link = len(out)
        out += bytes(4)
    return bytes(out)


@pytest.fixture(scope="module")
def stack():
    rng = np.random.default_rng(3)
    a = np.cumsum(rng.integers(0, 4, (7, 23, 31)), axis=2) + rng.integers(0, 3, (7, 23, 31)) * 1000
    return a.astype(np.uint16)


def test_codecs(stack):
    flat = np.zeros((2, 40, 60), np.uint8) + np.arange(2, dtype=np.uint8)[:, None, None]
    wide = np.random.default_rng(1).integers(0, 1 << 16, (1, 200, 90)).astype(np.uint16)  # fills the table of LZW several times
    signed = np.random.default_rng(2).integers(-5, 5, (1, 9, 11)).astype(np.int32)
    real = np.random.default_rng(2).random((1, 9, 11)).astype(np.float32)
    for a in (stack, flat, wide, signed, real):
        for compression in CODERS:
            for predictor in (1, 2) if a.dtype.kind != "f" else (1,):
                for tile in (None, (16, 16)):
                    for order in "<>":
                        got = list(tiff.pages(coded(a, compression, predictor, tile, order=order)))
                        assert len(got) == len(a) and all((x == y).all() for x, y in zip(got, a, strict=True)), (compression, predictor, tile, order)


def test_lzw_of_fixed_bytes():
    """Worked by hand: clear, 7, 7 7, 7 7 7, end, in nine bits each."""
    bits = "".join(f"{c:09b}" for c in (256, 7, 258, 259, 257)) + "000"
    assert tiff.unpack_lzw(bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8))) == bytes([7] * 6)
    for bad in (b"\x00\x00\x00", bytes(int(f"{256:09b}{300:09b}000000"[i : i + 8], 2) for i in range(0, 24, 8))):
        with pytest.raises(ValueError):
            tiff.unpack_lzw(bad)
    for fields in ({259: (7,)}, {258: (8, 8, 8)}, {277: (3,)}, {258: (4,)}):
        with pytest.raises(ValueError):
            tiff._page({256: (4,), 257: (4,), 258: (8,), 273: (8,), 279: (16,)} | fields, "<")


@pytest.mark.parametrize("compression", [1, 8, 5])
def test_blocks(spark, tmp_path, stack, compression, monkeypatch):
    """Chunks straight from a folder of slices and from one file of pages, in several tasks, in either kind of store."""
    monkeypatch.setattr(tiff, "SLAB_BYTES", 2000)
    (tmp_path / "slices").mkdir()
    for k, plane in enumerate(stack):
        (tmp_path / "slices" / f"s{k}.tif").write_bytes(coded([plane], compression, 2, (16, 16) if k % 2 else None))
    (tmp_path / "all.tif").write_bytes(coded(list(stack), compression, strip=4))
    chunk = (3, 8, 10)
    for path in ("slices", "all.tif"):
        found = tiff.parts(spark, str(tmp_path / path), chunk)
        assert found.select(F.spark_partition_id()).distinct().count() > 3
        made = tiff.assemble(found, chunk)
        assert made.count() == 3 * 3 * 4 and (whole(made, stack.shape) == stack).all()
        monkeypatch.setattr(tiff, "_mounted", lambda spark, path: None)
        assert (whole(tiff.read_blocks(spark, str(tmp_path / path), chunk), stack.shape) == stack).all()
        monkeypatch.undo()
        monkeypatch.setattr(tiff, "SLAB_BYTES", 2000)


def test_pushed_box(spark, tmp_path, stack, monkeypatch):
    """A box of bounds keeps files and strips closed."""
    monkeypatch.setattr(tiff, "SLAB_BYTES", 1)
    for k, plane in enumerate(stack):
        (tmp_path / f"s{k}.tif").write_bytes(tiff.encode([plane]))
    os.truncate(tmp_path / "s6.tif", 10)  # cannot be read
    key = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(key, "true")
    try:
        some = tiff.parts(spark, str(tmp_path), (3, 8, 31)).where("z0 < 5 and z1 >= 2 and y0 < 16 and y1 > 7")
        got = B.to_voxels(some).toPandas()
        assert sorted(got["z"].unique()) == [2, 3, 4] and sorted(got["y"].unique()) == list(range(8, 16))
        assert (stack[got["z"], got["y"], got["x"]] == got["v"]).all()
        assert some.rdd.getNumPartitions() <= 3
        with pytest.raises(Exception):
            tiff.parts(spark, str(tmp_path), (3, 8, 31)).count()
    finally:
        spark.conf.unset(key)


def test_files_out(spark, tmp_path, stack):
    table = chunked(spark, stack.astype("<u2"), (3, 8, 10))
    tiff.write_tiffs(table, str(tmp_path / "out"), stack.shape)
    assert sorted(os.listdir(tmp_path / "out")) == [f"slice_{k:04d}.tif" for k in range(7)]
    assert (whole(tiff.read_blocks(spark, str(tmp_path / "out"), (4, 9, 31)), stack.shape) == stack).all()
    images.write_nifti(voxels(spark, stack[:3, :5, :6]), (3, 5, 6), str(tmp_path / "a.nii.gz"))
    got = images.read_image(spark, str(tmp_path / "a.nii.gz")).toPandas()
    assert len(got) == 90 and (stack[got["z"], got["y"], got["x"]] == got["v"]).all()

    def fails(batches):
        for n, batch in enumerate(batches):
            yield batch
            if n == 0:
                raise RuntimeError("no")

    rows = spark.createDataFrame([("a", bytearray(b"x")), ("b", bytearray(b"y"))], "name string, content binary").coalesce(1)
    with pytest.raises(Exception):
        tiff.write_files(rows.mapInArrow(fails, rows.schema), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == []
    with pytest.raises(Exception):
        tiff.write_files(rows.mapInArrow(fails, rows.schema), str(tmp_path / "one"), joined=True)
    assert not (tmp_path / "one").exists() and not [n for n in os.listdir(tmp_path) if n.startswith("_temporary")]


def test_a_large_chunk_within_its_memory(spark, tmp_path):
    """A chunk's parts are put together, and its voxels spread, with a few times its own bytes."""
    import tracemalloc

    a = np.random.default_rng(0).integers(0, 1 << 16, (160, 160, 160)).astype("<u2")
    row = B.block_row(dict(zip(B.KEY + B.PLACE, [0, 0, 0, 0, 0, 0, *a.shape], strict=True)), a, 0)
    parts = [p for z in range(0, 160, 40) for p in tiff.block_parts(a[z : z + 40], (z, 0, 0), (160, 160, 160))]
    frame = B.pd.DataFrame(parts)
    del parts
    tracemalloc.start()
    array = np.zeros(a.shape, "<u2")
    for r in frame.to_dict("records"):
        array[int(r["z0"]) : int(r["z0"]) + int(r["nz"])] = B.block(r)
    assembled = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    step = max(1, B.SPREAD // array[0].size)
    for z in range(0, len(array), step):
        np.indices(B.core(row)[z : z + step].shape, np.int32)
    spread = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (array == a).all() and assembled < 2 * a.nbytes and spread < 4 * a.nbytes


def test_members(spark, tmp_path, monkeypatch):
    """A compressed file of several members is read by several tasks, whatever its members' borders."""
    a = np.random.default_rng(6).integers(0, 1 << 16, (9, 8, 11)).astype("<u2")
    data = images.nifti_header(a.shape, "<u2") + a.transpose(2, 1, 0).tobytes()
    cuts = [0, 100, 352, 1001, 1002, 1500, len(data)]
    import gzip

    whole_file = gzip.compress(data)
    many = b"".join(gzip.compress(data[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True))
    (tmp_path / "many.nii.gz").write_bytes(many)
    (tmp_path / "one.nii.gz").write_bytes(whole_file)
    (tmp_path / "plain.nii").write_bytes(data)
    monkeypatch.setattr(tiff, "SLAB_BYTES", 300)
    found = images.gzip_members(spark, str(tmp_path / "many.nii.gz"), len(many), step=97)
    assert [m[2] for m in found] == np.diff(cuts).tolist() and sum(m[1] for m in found) == len(many)
    for name, tasks in (("many.nii.gz", 6), ("one.nii.gz", 1), ("plain.nii", 6)):
        out = images.read_nifti(spark, str(tmp_path / name))
        assert out.rdd.getNumPartitions() == tasks
        got = out.toPandas()
        assert len(got) == a.size and (a[got["z"], got["y"], got["x"]] == got["v"]).all(), name
    (tmp_path / "short.nii.gz").write_bytes(b"".join(gzip.compress(data[i:j]) for i, j in ((0, 400), (400, 900))))
    with pytest.raises(ValueError):
        images.read_nifti(spark, str(tmp_path / "short.nii.gz"))
