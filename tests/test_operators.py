"""Hand-worked cases and properties of the volumetric operators."""

import itertools
import json
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxatlas import queries
from voxatlas.functions import scalar
from voxatlas.operators import cells, chunks, combine, kernels, masks, ontology, rasters, segments, stencils, voxels, warps
from voxatlas.operators.numbering import numbered
from voxatlas.plans import config as configs
from voxatlas.plans.config import Config
from voxatlas.plans.project import Project
from voxatlas.plans.stages import Pipeline, combine_folder, run_all
from voxatlas.sources import images, points, tables, tiff


def volume(spark, array):
    z, y, x = np.indices(array.shape).reshape(3, -1)
    return spark.createDataFrame([(int(a), int(b), int(c), int(v)) for a, b, c, v in zip(z, y, x, array.ravel(), strict=True)], "z int, y int, x int, v bigint")


def array(df, shape, value="v"):
    out = np.zeros(shape, np.int64)
    for r in df.collect():
        out[r["z"], r["y"], r["x"]] = r[value]
    return out


@pytest.fixture(scope="module")
def block():
    return np.random.default_rng(0).integers(0, 50, (7, 6, 9))


def tree(spark, edges):
    return spark.createDataFrame([(i, f"a{i}", f"n{i}", "ff", p, k) for k, (i, p) in enumerate(edges)], "id bigint, acronym string, name string, color_hex_triplet string, parent_structure_id bigint, preorder bigint")


def test_numbered(spark):
    rows = [(k * 7919 % 1000, "x") for k in range(500)]
    got = numbered(spark.createDataFrame(rows, "a int, b string").repartition(5), ["a"], "n").collect()
    assert [r["n"] for r in sorted(got, key=lambda r: r["a"])] == list(range(1, 501))
    assert numbered(spark.createDataFrame([], "a int"), ["a"], "n").count() == 0


def test_scalars(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (-1.5,)], "c double")
    assert [r[0] for r in df.select(scalar.round_half_even("c")).collect()] == [0, 2, 2, 0, -2]
    df = spark.createDataFrame([(0,), (1,), (5,), (65535,)], "c bigint")
    assert [r[0] for r in df.select(scalar.negate_unsigned("c")).collect()] == [0, 65535, 65531, 1]
    df = spark.createDataFrame([(3.9,), (70000.0,)], "c double")
    assert [r[0] for r in df.select(scalar.truncate("c", 16)).collect()] == [3, 4464]
    assert [r[0] for r in df.select(scalar.saturate("c")).collect()] == [4, 65535]
    names = spark.createDataFrame([("s10.tif",), ("s9.tif",), ("s009b.tif",)], "c string")
    assert [r[0] for r in names.orderBy(scalar.natural_key("c")).collect()] == ["s9.tif", "s009b.tif", "s10.tif"]
    assert {r[0] for r in names.select(scalar.zero_padded("c")).collect()} == {"s0010.tif", "s0009.tif", "s0009b.tif"}
    assert spark.range(1).select(scalar.ratio(F.lit(1), F.lit(0))).head()[0] is None


def test_rollup(spark):
    regions = tree(spark, [(1, None), (2, 1), (4, 2), (5, 2), (3, 1)])
    own = [(4, 2, 10, 100), (5, 1, 3, 30), (3, 4, 8, 0), (2, 1, 1, 1), (0, 7, 7, 7), (-1, 1, 1, 1), (99, 1, 2, 3), (None, 5, 5, 5)]
    got = ontology.group_cells(spark.createDataFrame(own, "id bigint, count bigint, volume bigint, sum_intensity bigint"), regions)
    want = {-1: (1, 1, 1), 0: (7, 7, 7), 1: (8, 22, 131), 2: (4, 14, 131), 3: (4, 8, 0), 4: (2, 10, 100), 5: (1, 3, 30), 99: (1, 2, 3)}
    assert {r["id"]: (r["count"], r["volume"], r["sum_intensity"]) for r in got.collect()} == want
    assert got.where("id = 1").head()["iov"] == pytest.approx(131 / 22)
    named = {r["id"]: r["name"] for r in ontology.map_ids(spark.createDataFrame([(-1,), (0,), (2,), (99,), (None,)], "id bigint"), regions).collect()}
    assert named == {-1: "invalid", 0: "universe", 2: "n2", 99: "no_label", None: "no_label"}


def test_ontology_round_trip(spark, tmp_path):
    leaf = lambda i, p, *c: {**{k: None for k in ontology.ONTOLOGY_FIELDS}, "id": i, "name": f"n{i}", "acronym": f"a{i}", "parent_structure_id": p, "children": list(c)}
    trees = [leaf(1, None, leaf(2, 1, leaf(4, 2)), leaf(3, 1)), leaf(9, None)]
    (tmp_path / "o.json").write_text(json.dumps({"msg": trees}))
    regions = ontology.read(spark, str(tmp_path / "o.json"))
    assert [r["preorder"] for r in regions.orderBy("preorder").collect()] == [0, 1, 2, 3, 4] and [r["id"] for r in regions.orderBy("preorder").collect()] == [1, 2, 4, 3, 9]
    assert json.loads(ontology.nest(regions).head()["value"]) == {"msg": trees}
    assert ontology.flatten(ontology.nest(regions)).exceptAll(regions).isEmpty()
    assert json.loads(ontology.nest(regions.limit(0)).head()["value"]) == {"msg": []}
    assert {r["id"]: r["children"] for r in ontology.with_children(regions).collect()} == {1: [2, 3], 2: [4], 3: [], 4: [], 9: []}
    limit = "spark.sql.cteRecursionLevelLimit"
    spark.conf.set(limit, "8")
    try:
        chain = tree(spark, [(0, None), *((k, k - 1) for k in range(1, 40))])  # deeper than a recursive query may go
        assert ontology.closure(chain).count() == 40 * 41 // 2
        assert ontology.closure(tree(spark, [(1, None), (2, 1), (3, 77)])).count() == 4
        with pytest.raises(ValueError):
            ontology.closure(tree(spark, [(1, 3), (2, 1), (3, 2), (4, None)]))
    finally:
        spark.conf.unset(limit)


def test_outline(spark):
    mask = volume(spark, np.array([[[0, 1, 1, 0, 1]]]))
    events = masks.outline(mask)
    assert sorted((r["is_in"], r["x"]) for r in events.collect()) == [(0, 2), (0, 4), (1, 1), (1, 4)]
    assert array(masks.fill(events, 5).withColumn("v", F.lit(1)), (1, 1, 5)).tolist() == [[[0, 1, 1, 0, 1]]]
    lost = events.where("not (is_in = 0 and x = 4)")
    assert array(masks.fill(lost, 6).withColumn("v", F.lit(1)), (1, 1, 6)).tolist() == [[[0, 1, 1, 0, 1, 1]]]


def test_rasters(spark):
    assert [len(rasters.ball(r, s)) for s in (True, False) for r in (3, 5)] == [93, 485, 123, 515]
    three = spark.createDataFrame([(1.2, 1.0, 1.0)] * 3 + [(9.0, 0.0, 0.0)], "z double, y double, x double")
    assert [r["v"] for r in rasters.points_distinct(three, (3, 3, 3)).collect()] == [1]
    assert [r["v"] for r in rasters.points_count(three, (3, 3, 3)).collect()] == [3]
    assert rasters.dense(rasters.points_count(three, (3, 3, 3)), (3, 3, 3)).count() == 27


def test_lookup(spark):
    found = spark.createDataFrame([(0.0, 0.0, 0.0), (5.0, 0.0, 0.0), (0.0, 0.0, 1.0)], "z_trfm double, y_trfm double, x_trfm double")
    grid = spark.createDataFrame([(0, 0, 0, 5), (0, 0, 1, 6)], "z int, y int, x int, id bigint")
    assert sorted(str(r["id"]) for r in cells.region_lookup(found, grid).collect()) == ["5", "6", "None"]
    assert sorted(r["id"] for r in cells.region_lookup(found, grid, oob="invalid").collect()) == [-1, 5, 6]
    moved = cells.affine(spark.createDataFrame([(1.0, 2.0, 3.0)], "z double, y double, x double"), [[0, 1, 0], [2, 0, 0], [0, 0, 1]], [1, 0, -1]).head()
    assert (moved["z"], moved["y"], moved["x"]) == (3.0, 2.0, 2.0)


def test_slices(spark, block):
    df = volume(spark, block)
    for slices in [((1, 6, 2), (None, -1, None), (7, None, -2)), ((None, None, -1), (2, 3, 1), (-4, None, 3))]:
        want = block[tuple(slice(*s) for s in slices)]
        got = voxels.trim(df, slices)
        assert got.count() == want.size and (array(got, want.shape) == want).all()
    for order in [(1, 2, 3), (-2, 3, -1), (3, -1, 2)]:
        flipped = block.copy()
        for e in order:
            if e < 0:
                flipped = np.flip(flipped, abs(e) - 1)
        want = flipped.transpose([abs(e) - 1 for e in order])
        assert (array(voxels.reorient(df, order, block.shape), want.shape) == want).all()


def test_otsu(spark):
    values = [0] * 50 + [10] * 5 + [1000] * 10
    df = volume(spark, np.array(values).reshape(1, 5, 13))
    assert voxels.otsu_bin(voxels.histogram(df, 256)).head()[0] == 2
    assert voxels.otsu_threshold(df).agg(F.sum("v")).head()[0] == 15


def test_counts_beyond_64_bits(spark):
    """Histograms of a billion voxels, and squares that do not fit 64 bits."""
    counts = [(0, 900_000_000), (3, 80_000_000), (200, 40_000_000)]
    assert voxels.otsu_bin(spark.createDataFrame(counts, "bin int, n bigint")).head()[0] == 3
    large = spark.createDataFrame([(0, 0, x, v) for x, v in enumerate([3 * 10**9] * 3 + [4 * 10**9])], "z int, y int, x int, v bigint")
    assert sorted((r["x"], r["v"]) for r in voxels.mean_threshold(large, 1).collect()) == [(0, 0), (1, 0), (2, 0), (3, 1)]


@pytest.mark.parametrize("size", [3, 4])
def test_stencils_equal_kernels(spark, block, size):
    df = volume(spark, block)
    assert (array(stencils.tophat(df, size), block.shape) == kernels.tophat(block, size)).all()
    assert (array(stencils.local_maxima(df, size), block.shape) == kernels.local_maxima(block, size)).all()
    smooth = stencils.gaussian(df, 1.0).collect()
    want = kernels.gaussian(block, 1.0)
    assert max(abs(r["v"] - want[r["z"], r["y"], r["x"]]) for r in smooth) < 1e-3


def test_components(spark):
    rng = np.random.default_rng(3)
    mask = (rng.random((6, 7, 8)) < 0.45).astype(int)
    found = segments.number_labels(segments.connected_components(volume(spark, mask).where("v = 1")))
    assert (array(found, mask.shape, "label") == kernels.label(mask)).all()
    assert (array(segments.label_volumes(found), mask.shape, "volume") == kernels.volumes(kernels.label(mask))).all()
    snake = np.zeros((1, 15, 15), int)
    snake[0, ::2] = 1
    snake[0, 1::4, -1] = snake[0, 3::4, 0] = 1
    assert segments.connected_components(volume(spark, snake).where("v = 1")).select("component").distinct().count() == 1


def test_halos(spark, block):
    df, size = volume(spark, block), (3, 4, 5)
    parts = chunks.from_voxels(df, block.shape, size)
    assert (array(chunks.to_voxels(parts), block.shape) == block).all()
    padded = np.pad(block, 4, mode="symmetric")
    for r in chunks.add_halo(parts, block.shape, size, 4).collect():
        z, y, x = r["z0"], r["y0"], r["x0"]
        assert (chunks.block(r.asDict()) == padded[z : z + r["nz"] + 8, y : y + r["ny"] + 8, x : x + r["nx"] + 8]).all()
    assert (array(chunks.to_voxels(chunks.trim_halo(chunks.add_halo(parts, block.shape, size, 4))), block.shape) == block).all()


def test_blocks_at_a_time(spark, sf, block):
    """A block goes to its function where its halo is put together, and frames of small parts are bounded by rows too."""
    size, schema = (3, 4, 5), "z bigint, y bigint, x bigint, total bigint"
    parts = chunks.from_voxels(volume(spark, block), block.shape, size)

    def total(v):
        return {"z": [1], "y": [0], "x": [2], "total": [v.astype(np.int64).sum()]}

    for depth in (0, 2):
        apart = chunks.blocks_to_table(chunks.zip_blocks({"halo": chunks.add_halo(parts, block.shape, size, depth)}), ["halo"], total, schema)
        at_once = chunks.halo_to_table(parts, block.shape, size, depth, total, schema)
        assert at_once.schema == apart.schema and sorted(at_once.collect()) == sorted(apart.collect())
    row = dict.fromkeys(chunks.KEY + chunks.PLACE, 0) | {"halo": 0, "dtype": "<u2", "payload": b"1234"}
    frames = list(chunks.frames_of(row for _ in range(5000)))
    assert sum(map(len, frames)) == 5000 and max(map(len, frames)) * chunks.ROW_BYTES <= chunks.FRAME_BYTES
    assert list(chunks.records(iter(frames[:1])))[0] == row
    plan = queries.watershed_cells(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("FlatMapGroupsInPandas") == 2 and plan.count(" MapInPandas") == 1


def test_wide_kernels():
    """Fourier transforms and doubled windows against plain sums and windows."""
    rng = np.random.default_rng(5)
    block = rng.integers(0, 5000, (9, 30, 17)).astype(np.float32)
    weights = stencils.gaussian_weights(11.0)
    assert len(weights) > kernels.MANY
    r, want = len(weights) // 2, block.astype(float)
    for axis in range(3):
        padded = np.moveaxis(np.pad(want, [(r, r) if a == axis else (0, 0) for a in range(3)], mode="symmetric"), axis, 0)
        want = np.moveaxis(sum(w * padded[k : k + block.shape[axis]] for k, w in enumerate(weights)), 0, axis)
    assert np.allclose(kernels.convolve(block, weights), want, rtol=1e-5)
    for size in range(1, 12):
        for mirror in (False, True):
            low, high = stencils.window(size, mirror)
            want = block
            for axis in range(3):
                padded = np.moveaxis(np.pad(want, [(max(0, -low), max(0, high)) if a == axis else (0, 0) for a in range(3)], mode="symmetric"), axis, 0)
                first = low + max(0, -low)
                want = np.moveaxis(np.max([padded[first + k : first + k + block.shape[axis]] for k in range(size)], axis=0), 0, axis)
            assert (kernels.max_filter(block, size, mirror) == want).all()


def test_bits(spark, block):
    """A mask of bits is the mask, at every size of halo."""
    table = chunks.add_halo(chunks.from_voxels(volume(spark, block), block.shape, (3, 4, 5)), block.shape, (3, 4, 5), 2)
    packed = chunks.as_bits(table)
    both = chunks.zip_blocks({"a": table, "b": packed}).toPandas().to_dict("records")
    assert len(both) == 3 * 2 * 2
    for row in both:
        a, b = chunks.block(row, "a_payload", "a_dtype", "a_halo"), chunks.block(row, "b_payload", "b_dtype", "b_halo")
        assert ((a != 0) == b).all() and len(row["b_payload"]) == -(-a.size // 8)


def test_watershed():
    raw = np.array([[[9, 5, 1, 4, 8]]])
    markers = np.array([[[1, 0, 0, 0, 2]]])
    assert kernels.watershed(raw, markers, np.ones_like(raw)).tolist() == [[[1, 1, 1, 2, 2]]]
    mask = np.array([[[1, 0, 1, 1, 1]]])
    assert kernels.watershed(raw, markers, mask).tolist() == [[[1, 0, 2, 2, 2]]]


def test_combine(spark):
    regions = tree(spark, [(1, None), (2, 1)])
    agg = spark.createDataFrame([(1, 2, 3, 4, 0.5)], "id bigint, count bigint, volume bigint, sum_intensity bigint, iov double")
    mask = spark.createDataFrame([(2, 5, 6, 0.1)], "id bigint, volume_annot bigint, volume_mask bigint, volume_prop double")
    one = combine.specimen_table(agg, mask)
    wide = {r["id"]: r for r in combine.combine_wide(combine.annotations(spark, regions), {"s 1": one, "s2": one.where("id = 1")}).collect()}
    assert set(wide) == {-1, 0, 1, 2} and wide[1]["s 1__count"] == 2 and wide[1]["s 1__volume_mask"] is None and wide[2]["s2__volume_annot"] is None
    assert combine.combine_long({"a": one}).count() == 7
    rows = [tuple(r) for r in combine.with_two_headers(combine.combine_wide(combine.annotations(spark, regions), {"s1": one, "s2": one})).collect()]
    assert rows[0] == ("specimen", *["annotations"] * 5, *["s1"] * 7, *["s2"] * 7) and rows[1][:3] == ("measure", "name", "acronym") and rows[1][6:13] == tuple(combine.MEASURES)
    assert [r[0] for r in rows[2:]] == ["-1", "0", "1", "2"] and rows[4][6:9] == ("2", "3", "4")


def test_files(spark, tmp_path, block):
    for k, plane in enumerate(block):
        (tmp_path / f"slice_{k}.tif").write_bytes(tiff.encode([plane.astype(np.uint16)]))
    assert (array(tiff.read_stack(spark, str(tmp_path)), block.shape) == block).all()
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "all.tiff").write_bytes(tiff.encode(list(block.astype(np.uint8))))
    assert (array(tiff.read_stack(spark, str(tmp_path / "one")), block.shape) == block).all()
    files = tiff.slice_files(volume(spark, block)).collect()
    assert all((next(tiff.pages(bytes(r["content"]))) == block[r["z"]]).all() for r in files)
    xyz = spark.createDataFrame([(k, 1.5 * k, 2.0, -k / 4) for k in range(6)], "cell_id bigint, z double, y double, x double")
    points.write_points(xyz, str(tmp_path / "points"))
    assert sorted(map(tuple, points.read_points(spark, str(tmp_path / "points")).collect())) == sorted((r["z"], r["y"], r["x"]) for r in xyz.collect())
    (tmp_path / "out.txt").write_text("Point\t3\t; InputIndex = [ 1 2 3 ]\t; OutputPoint = [ 1.5 2.5 -3 ]\t; Deformation = [ 0 0 0 ]\n")
    assert [tuple(r) for r in points.read_output_points(spark, str(tmp_path / "out.txt")).collect()] == [(3, -3.0, 2.5, 1.5)]
    (tmp_path / "empty.txt").write_text("")
    assert points.read_output_points(spark, str(tmp_path / "empty.txt")).count() == 0
    table = tables.write_parquet(xyz.withColumn(tables.SHARE_COLUMN, F.lit(1)), str(tmp_path / "t"))
    assert tables.SHARE_COLUMN in table.columns and tables.SHARE_COLUMN not in tables.read_parquet(spark, str(tmp_path / "t")).columns
    assert tables.exists(spark, str(tmp_path / "t")) and not tables.exists(spark, str(tmp_path / "none"))


def big_tiff(images, strip, order):
    """A BigTIFF file whose strips of ``strip`` rows lie in reverse order, with a gap between them."""
    out, link = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HHHQ", 43, 8, 0, 0)), 8
    for image in images:
        image = image.astype(image.dtype.newbyteorder(order))
        strips = [image[k : k + strip].tobytes() for k in range(0, len(image), strip)]
        offsets = []
        for s in reversed(strips):
            offsets.insert(0, len(out))
            out += s + b"gap"
        lists = len(out)
        out += struct.pack(f"{order}{len(strips)}Q", *offsets) + struct.pack(f"{order}{len(strips)}Q", *map(len, strips))
        struct.pack_into(order + "Q", out, link, len(out))
        place = lambda at, values: at if len(strips) > 1 else values[0]
        fields = [(256, 1, image.shape[1]), (257, 1, image.shape[0]), (258, 1, image.dtype.itemsize * 8), (273, len(strips), place(lists, offsets)), (279, len(strips), place(lists + 8 * len(strips), [len(strips[0])])), (339, 1, 1)]
        out += struct.pack(order + "Q", len(fields)) + b"".join(struct.pack(order + "HHQQ", tag, 16, count, value) for tag, count, value in fields)
        link = len(out)
        out += bytes(8)
    return bytes(out)


def test_file_of_many_pages(spark, tmp_path, block, monkeypatch):
    """One file is dealt out, also one larger than Spark reads whole, and BigTIFF is read."""
    monkeypatch.setattr(tiff, "SLAB_BYTES", 40)
    images = list(block.astype(np.uint16))
    files = {"classic": tiff.encode(images), "big end": big_tiff(images, 4, ">"), "little": big_tiff(images, 4, "<"), "one": big_tiff(images, 99, "<")}
    limit = "spark.sql.sources.binaryFile.maxLength"
    for name, data in files.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "all.tif").write_bytes(data)
        assert all((a == b).all() for a, b in zip(tiff.pages(data), block, strict=True))
        spark.conf.set(limit, "100")
        try:
            got = tiff.read_stack(spark, str(tmp_path / name)).withColumn("task", F.spark_partition_id())
            assert got.count() == block.size and (array(got, block.shape) == block).all()
            assert got.select("task").distinct().count() > 1
        finally:
            spark.conf.unset(limit)
    # in a store that only Spark reads
    monkeypatch.setattr(tiff, "_mounted", lambda spark, path: None)
    got = tiff.read_stack(spark, str(tmp_path / "little"))
    assert got.count() == block.size and (array(got, block.shape) == block).all()


def test_config(spark, tmp_path):
    path = str(tmp_path / "config")
    assert configs.update(spark, path, threshold=7).threshold == 7
    assert configs.update(spark, path, chunk=(4, 4, 4)) == Config(threshold=7, chunk=(4, 4, 4)) == configs.read(spark, path)
    for bad in ({"ref_orient": (1, 1, 2)}, {"lower_bound": (9, 0), "upper_bound": (5, 5)}):
        with pytest.raises(ValueError):
            Config(**bad)
    assert Project("/p").for_tuning().path("overlap") == "/p/cellcount_tuning/overlap"
    with pytest.raises(KeyError):
        Project("/p").path("nothing")

    def fails():
        raise RuntimeError("no")

    assert list(run_all({"a": fails, "b": lambda: None})) == ["a"]


def test_transformations(spark):
    """A constant B-spline field moves by itself, a linear one linearly; beyond the field nothing moves."""
    places = spark.createDataFrame([(k, 0.5 + k, 2.0, 3.25) for k in range(5)], "cell_id bigint, z double, y double, x double")
    grid = spark.createDataFrame([(a, b, c, 1.5, -0.5 * b, float(a)) for a in range(6) for b in range(6) for c in range(6)], "gz int, gy int, gx int, dz double, dy double, dx double")
    got = {r["cell_id"]: r for r in warps.bspline(places, grid, (-2, -2, -2), (2, 2, 2)).collect()}
    for k in range(5):
        inside = 1 <= (0.5 + k + 2) / 2 < 4
        want = (0.5 + k + 1.5, 2.0 - 0.5 * 2.0, 3.25 + (0.5 + k + 2) / 2) if inside else (0.5 + k, 2.0, 3.25)
        assert (got[k]["z"], got[k]["y"], got[k]["x"]) == pytest.approx(want)
    image = volume(spark, np.arange(24).reshape(2, 3, 4))
    assert (array(warps.warp_image(image, (2, 3, 4), lambda p: p), (2, 3, 4)) == np.arange(24).reshape(2, 3, 4)).all()


def test_image_files(spark, tmp_path, block):
    df = volume(spark, block)
    parts = sorted(images.nifti_members(df, block.shape).collect(), key=lambda r: r["part"])
    (tmp_path / "a.nii.gz").write_bytes(b"".join(bytes(r["content"]) for r in parts))
    assert (array(images.read_image(spark, str(tmp_path / "a.nii.gz")), block.shape) == block).all()
    chunks.from_voxels(df, block.shape, (3, 4, 5)).write.parquet(str(tmp_path / "a.parquet"))
    box = ((1, 6, 2), (None, 3, None), (2, None, None))
    want = block[tuple(slice(*s) for s in box)]
    assert (array(images.read_image(spark, str(tmp_path / "a.parquet"), box), want.shape) == want).all()
    images.write_slices(df, str(tmp_path / "slices"))
    (tmp_path / "s.tif").write_bytes(tiff.encode([next(tiff.pages(bytes(r["content"]))) for r in spark.read.parquet(str(tmp_path / "slices")).orderBy("z").collect()]))
    assert (array(images.read_image(spark, str(tmp_path / "s.tif")), block.shape) == block).all()
    with pytest.raises(NotImplementedError):
        images.read_image(spark, "x.png")
    np.save(tmp_path / "a.npy", block.astype(np.uint16))
    skip, shape, dtype = images.npy_header((tmp_path / "a.npy").read_bytes())
    assert (shape, dtype) == (block.shape, np.dtype("<u2")) and skip + block.size * 2 == (tmp_path / "a.npy").stat().st_size
    text = images.mhd((tmp_path / "a.npy").read_bytes(), "a.npy")
    assert "DimSize = 9 6 7\n" in text and "ElementType = MET_USHORT\n" in text
    assert tables.remove(spark, str(tmp_path / "a.npy")) and not tables.remove(spark, str(tmp_path / "a.npy"))


def test_watershed_by_pieces():
    """Flooding piece by piece is flooding of the whole."""
    rng = np.random.default_rng(12)
    for _ in range(5):
        raw, mask = rng.integers(0, 40, (6, 7, 8)), rng.random((6, 7, 8)) < 0.6
        markers = np.where(rng.random(raw.shape) < 0.05, rng.integers(1, 9, raw.shape), 0)
        assert (kernels.watershed(raw, markers, mask) == kernels._flooded(raw, markers, mask, True)).all()


def spotted(seed):
    rng = random.Random(seed)
    raw = np.full((12, 16, 16), 10)
    centres = [(3, 4, 4), (8, 11, 5), (5, 6, 12)]
    for c in centres:
        for d in itertools.product((-1, 0, 1), repeat=3):
            raw[tuple(a + b for a, b in zip(c, d, strict=True))] = 900 - 100 * sum(map(abs, d)) - rng.randint(0, 5)
    return raw, centres


SPOTTED = Config(chunk=(6, 8, 8), overlap_depth=5, tophat_sigma=5, dog_sigma1=1, dog_sigma2=4, large_gauss_sigma=8, threshold=20, min_threshold_size=4, max_threshold_size=200, maxima_sigma=5, max_wshed_size=300, rough=(1, 1, 1), fine=(1.0, 1.0, 1.0), lower_bound=(5, 0), mask_threshold=8, tuning_trim=((0, 6, None), (0, 16, None), (0, 16, None)), combine_cellc_trim=((2, 9, None), (None, None, None), (None, None, None)))


def test_two_specimens(spark, tmp_path):
    """Everything for two specimens, one from image files, then the folder's combined table."""
    regions = tree(spark, [(1, None), (2, 1), (3, 1)])
    for name, seed in (("s10", 6), ("s9", 7)):
        raw, centres = spotted(seed)
        annotation = volume(spark, np.where(np.indices(raw.shape)[2] < 8, 2, 3)).withColumnRenamed("v", "id")
        project = Project(str(tmp_path / "all" / name))
        configs.write(spark, SPOTTED, project.config)
        source = volume(spark, raw)
        if name == "s9":
            source = str(tmp_path / "raw.tif")
            (tmp_path / "raw.tif").write_bytes(tiff.encode(list(raw.astype(np.uint16))))
        out = Pipeline(spark, project).run(source, annotation, regions, tuning=name == "s9", visual=name == "s9")
        assert {r["id"]: r["count"] for r in out.collect()} == {1: 3, 2: 2, 3: 1}
        share = {r["id"]: r["volume_prop"] for r in spark.read.parquet(project.path("mask_regions")).collect()}
        # the mask is the whole image: closing eats two voxels at its borders, and opening the corners
        assert share == {1: 848 / 3072, 2: 424 / 1536, 3: 424 / 1536}
    tuned = spark.read.parquet(project.for_tuning().path("cells_raw"))
    assert {(r["z"], r["y"], r["x"]) for r in tuned.collect()} == {c for c in centres if c[0] < 6}
    stack = spark.read.parquet(project.path("stack_cells"))
    assert stack.count() == 7 * 16 * 16 and stack.agg(F.max("c0")).head()[0] == min(900, raw.max())
    assert spark.read.parquet(project.path("points_trfm")).count() == 3
    assert spark.read.csv(project.path("cells_agg_csv"), header=True).count() == 3
    both = combine_folder(spark, str(tmp_path / "all"), regions, str(tmp_path / "out"))
    assert {r["id"]: (r["s9__count"], r["s10__count"], r["s9__volume_mask"]) for r in both.where("id > 0").collect()} == {1: (3, 3, 848), 2: (2, 2, 424), 3: (1, 1, 424)}
    assert combine_folder(spark, str(tmp_path / "all"), regions, str(tmp_path / "out")).columns == both.columns
    pipeline = Pipeline(spark, project)
    tables_ = {n: spark.read.parquet(project.path(n)) for n in ("overlap", "maxima", "threshold_filtered", "cells_raw")}
    labels = pipeline.maxima_labels(tables_["maxima"])
    again = pipeline.cells_from_labels(tables_["overlap"], labels, tables_["threshold_filtered"])
    measures = lambda df: sorted((r["z"], r["y"], r["x"], r["volume"], r["sum_intensity"]) for r in df.collect())
    assert measures(again) == measures(tables_["cells_raw"])
    assert {(r["z"], r["y"], r["x"]) for r in pipeline.cells_coords(tables_["maxima"]).collect()} == set(centres)
    with pytest.raises(ValueError):
        pipeline.ingest(str(tmp_path / "none.png"))


def test_command_line(spark, tmp_path, capsys):
    from voxatlas.__main__ import main

    main(["config", str(tmp_path / "p"), "--set", '{"threshold": 7}'])
    assert json.loads(capsys.readouterr().out)["threshold"] == 7
    assert configs.read(spark, Project(str(tmp_path / "p")).config).threshold == 7
    main(["project", str(tmp_path / "q")])
    assert "(NumberOfHistogramBins 128)" in (tmp_path / "q/registration/parameters/align_bspline.txt").read_text()
    with pytest.raises(SystemExit):
        main(["combine"])


def test_pipeline(spark, tmp_path):
    raw, centres = spotted(6)
    annotation = volume(spark, np.where(np.indices(raw.shape)[2] < 8, 2, 3)).withColumnRenamed("v", "id")
    pipeline = Pipeline(spark, Project(str(tmp_path)), SPOTTED)
    got = {r["id"]: r["count"] for r in pipeline.run(volume(spark, raw), annotation, tree(spark, [(1, None), (2, 1), (3, 1)]), mask=False, tuning=False).collect()}
    assert got == {1: 3, 2: 2, 3: 1}
    found = {(r["z"], r["y"], r["x"]) for r in spark.read.parquet(Project(str(tmp_path)).path("cells_raw")).collect()}
    assert found == set(centres)


def test_cubic_resampling(spark):
    """Against splines whose coefficients are solved for, on lines of every small length."""
    rng = np.random.default_rng(4)

    def plain(line, m):
        n = len(line)
        if n == 1:
            return np.repeat(line, m)
        mirror = lambda k: min(k % (2 * n - 2), (2 * n - 2) - k % (2 * n - 2))
        solve = np.zeros((n, n))
        for k in range(n):
            for d, w in ((-1, 1 / 6), (0, 4 / 6), (1, 1 / 6)):
                solve[k, mirror(k + d)] += w
        c = np.linalg.solve(solve, line)
        basis = lambda t: 2 / 3 - t * t + abs(t) ** 3 / 2 if abs(t) < 1 else max(2 - abs(t), 0) ** 3 / 6
        at = [j * (n - 1) / max(m - 1, 1) for j in range(m)]
        return np.array([sum(c[mirror(k)] * basis(x - k) for k in range(int(x) - 2, int(x) + 4)) for x in at])

    for n in (1, 2, 3, 5, 17, 90):
        for m in (1, 2, n, 2 * n + 1):
            place, weights = stencils.spline_taps(n, m)
            line = rng.random(n) * 1000
            assert np.allclose((line[place] * weights).sum(axis=0), plain(line, m), atol=1e-8)
    block = rng.integers(0, 65536, (7, 6, 9))
    want = block.astype(float)
    for axis, m in ((1, 4), (2, 14)):
        want = np.apply_along_axis(plain, axis, want, m)
    out = stencils.resample(volume(spark, block), (1.0, 0.6, 1.5), bits=16)
    assert out.count() == want.size
    assert (array(out, want.shape) == np.clip(np.floor(want + 0.5), 0, 65535)).all()
    assert stencils.resample(volume(spark, block).where("false"), (0.5, 0.5, 0.5)).collect() == []


def test_linear_resampling_of_a_long_axis(spark):
    n, m = 60_000, 42_000
    line = spark.range(n).select(F.col("id").cast("int").alias("z"), F.lit(0).alias("y"), F.lit(0).alias("x"), (F.col("id") * 7 % 1000).alias("v"))
    got = stencils.resample(line, (0.7, 1, 1), order=1).toPandas().sort_values("z")
    at = np.arange(m) * (n - 1)
    assert got["z"].tolist() == list(range(m))
    assert np.allclose(got["v"], np.interp(at / (m - 1), np.arange(n), np.arange(n) * 7 % 1000), atol=1e-6)


def test_components_without_broadcasts(spark):
    """No table of runs, names or labels goes through the driver, however small."""
    labelled = segments.number_labels(segments.connected_components(spark.createDataFrame([(0, 0, 0), (0, 1, 0), (3, 0, 5)], "z int, y int, x int")))
    for df in (labelled, segments.label_volumes(labelled)):
        assert len(df.collect()) == 3
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
