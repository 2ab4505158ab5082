"""Splines over chunks, transformations, and registration from its slopes to a whole specimen."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxatlas.operators import chunks as B
from voxatlas.operators import kernels, splines
from voxatlas.operators import registration as J
from voxatlas.operators.transforms import Affine, BSplineField, Chain, move_points
from voxatlas.plans import config as configs
from voxatlas.plans.config import Config
from voxatlas.plans.project import Project
from voxatlas.plans.stages import Pipeline, combine
from voxatlas.sources import transforms as files


def chunked(spark, a, chunk):
    rows = []
    for key in itertools.product(*(range(-(-n // c)) for n, c in zip(a.shape, chunk, strict=True))):
        start = [k * c for k, c in zip(key, chunk, strict=True)]
        part = a[tuple(slice(s, s + c) for s, c in zip(start, chunk, strict=True))]
        rows.append(B.block_row(dict(zip(B.KEY + B.PLACE, [*key, *start, *part.shape], strict=True)), part, 0))
    return spark.createDataFrame(B.frame(rows), B.SCHEMA).repartition(3)


def whole(df, sizes):
    out = np.full(sizes, np.nan)
    for row in df.toPandas().to_dict("records"):
        part = B.block(row)
        out[tuple(slice(int(row[f"{a}0"]), int(row[f"{a}0"]) + n) for a, n in zip(B.AXES, part.shape, strict=True))] = part
    return out


def dense(a):
    """Coefficients by one matrix an axis."""
    for axis in range(3):
        n = a.shape[axis]
        m = np.zeros((n, n))
        for k, d in itertools.product(range(n), range(-45, 46)):
            m[k, splines.fold(k + d, n)] += np.sqrt(3) * splines.POLE ** abs(d)
        a = np.moveaxis(np.tensordot(m, a, (1, axis)), 0, axis)
    return a


@pytest.mark.parametrize(("sizes", "chunk"), [((40, 17, 9), (16, 17, 4)), ((5, 3, 2), (2, 2, 1)), ((70, 4, 8), (64, 3, 8))])
def test_splines_over_chunks(spark, sizes, chunk):
    a = np.random.default_rng(0).integers(0, 60_000, sizes).astype("<u2")
    table = chunked(spark, a, chunk)
    want = dense(a.astype(float))
    assert np.abs(whole(splines.coefficients(table, sizes, chunk), sizes) - want).max() < 1e-8
    assert (whole(splines.warp_image(table, sizes, chunk, sizes, (7, 9, 11), Chain(()), "<u2"), sizes) == a).all()
    move = Affine(np.array([[0.9, 0.1, 0], [0, 1.1, 0.05], [0.02, 0, 1]]), np.array([0.3, -0.2, 0.1]), np.zeros(3))
    target = (12, 4, 9)
    seen = whole(splines.warp_image(table, sizes, chunk, target, (5, 4, 4), move), target)
    places = move(splines.grid([0, 0, 0], list(target)))
    held = splines.inside(places, sizes)
    plain = np.zeros(places.shape[1])
    plain[held] = splines.read(np.pad(want, 2, mode="reflect"), np.full(3, -2), places[:, held])
    assert np.abs(seen.ravel() - plain).max() < 1e-8 and held.any()
    linear = whole(splines.warp(table, sizes, chunk, target, (5, 4, 4), move, order=1), target)
    corners = np.pad(a.astype(float), ((0, 1),) * 3)
    first = np.floor(places[:, held]).astype(int)
    part = places[:, held] - first
    by_hand = sum(np.prod([p if o else 1 - p for p, o in zip(part, offset, strict=True)], axis=0) * corners[tuple(f + o for f, o in zip(first, offset, strict=True))] for offset in itertools.product((0, 1), repeat=3))
    assert np.abs(linear.ravel()[held] - by_hand).max() < 1e-8


def test_transformations_and_their_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    turn = Affine(np.eye(3) + rng.normal(size=(3, 3)) / 10, rng.normal(size=3), rng.normal(size=3) * 10)
    field = BSplineField.still((40, 30, 20), (8, 7, 6))
    field = BSplineField(rng.normal(size=field.grid.shape), field.origin, field.spacing)
    p = rng.uniform(0, 19, (3, 200))
    assert np.allclose(turn.inverse()(turn(p)), p) and field.around(p)[2].all()
    assert np.allclose(field.refined()(p), field(p)) and not np.allclose(field(p), p)
    for axis in range(3):
        step = 1e-5 * np.eye(3)[:, [axis]]
        assert np.allclose((field(p + step) - field(p - step)) / 2e-5, field.slope(p)[:, axis], atol=1e-6)
    beyond = np.array([[100.0], [5.0], [5.0]])
    assert (field(beyond) == beyond).all()
    with pytest.raises(ValueError):
        BSplineField.still((10_000, 10_000, 10_000), (10, 10, 10))
    chain = Chain((turn, field))
    files.write_chain(spark, chain, str(tmp_path / "t"))
    again = files.read_chain(spark, str(tmp_path / "t"))
    assert (again(p) == chain(p)).all() and (files.read_transform(spark, str(tmp_path / "t/TransformParameters.0.txt"))(p) == turn(p)).all()
    for bad in ({"Transform": ["EulerTransform"], "TransformParameters": ["1"]}, {"Transform": ["AffineTransform"], "TransformParameters": ["1"]}):
        with pytest.raises(ValueError):
            files.transform(bad)
    rows = [(k, float(x), float(y), float(z), "kept") for k, (z, y, x) in enumerate(p.T)] + [(-1, None, 1.0, 2.0, None)]
    points = spark.createDataFrame(rows, "id int, x double, y double, z double, _0 string").repartition(3)
    moved = move_points(points, chain)
    assert moved.columns == points.columns and moved.where("id < 0 and x is null and _0 is null").count() == 1
    got = moved.where("id >= 0").orderBy("id").toPandas()
    assert np.allclose(got[["z", "y", "x"]].to_numpy().T, chain(p)) and (got["_0"] == "kept").all()
    assert move_points(points.limit(0), chain).count() == 0


def smooth(sizes, seed=0):
    a = kernels.gaussian(np.random.default_rng(seed).normal(size=sizes), 3.0)
    return ((a - a.min()) / (a.max() - a.min()) * 2000).astype("<f4")


@pytest.fixture(scope="module")
def moving(spark):
    sizes, chunk = (30, 36, 34), (16, 16, 16)
    return J.Image(chunked(spark, smooth(sizes), chunk), sizes, chunk)


def test_slopes(moving):
    """The slopes of the measure against its differences, and its value against a plain histogram."""
    samples = J.sample(moving, (1, 1, 1), 1500)
    assert 1400 < len(samples.values) < 1600
    measure = J.Measure(moving, (1, 1, 1), samples, 20)
    move = Affine(np.eye(3) + 0.01, np.array([0.3, 0.2, -0.4]), np.array([14.5, 17.5, 16.5]))
    value, slope = measure.affine(move)
    for k in (0, 5, 9, 11):
        step = np.zeros(12)
        step[k] = 1e-5
        at = lambda e: measure.affine(Affine(move.matrix + e[:9].reshape(3, 3), move.offset + e[9:], move.centre))[0]
        assert slope[k] == pytest.approx((at(step) - at(-step)) / 2e-5, rel=1e-3, abs=1e-6)
    field = BSplineField.still(moving.sizes, (12, 12, 12))
    field = BSplineField(np.random.default_rng(2).normal(size=field.grid.shape) / 2, field.origin, field.spacing)
    slope = measure.field(move, field, measure.joint(lambda p: field(move(p))))
    for k in ((2, 2, 2, 0), (3, 3, 3, 2)):
        step = np.zeros(field.grid.shape)
        step[k] = 1e-4
        at = lambda e: J.information(measure.joint(lambda p: BSplineField(field.grid + e, field.origin, field.spacing)(move(p))))[0]  # noqa: B023, E731
        assert slope[k] == pytest.approx((at(step) - at(-step)) / 2e-4, rel=1e-3, abs=1e-7)
    measure.close()
    box = np.pad(dense(whole(moving.chunks, moving.sizes)), 2, mode="reflect")
    places = move(samples.places)
    held = splines.inside(places, moving.sizes, J.SLACK)
    seen = splines.read(box, np.full(3, -2), places[:, held])
    joint, ends = np.zeros((20, 20)), moving.range()
    basis = lambda t: np.where(t < 1, 2 / 3 - t * t + t**3 / 2, np.maximum(2 - t, 0) ** 3 / 6)
    bins = lambda v, low, high: basis(np.abs(1 + (np.clip(v, low, high) - low) * 17 / (high - low) - np.arange(20)))
    for f, m in zip(samples.values[held], seen, strict=True):
        joint += np.outer(bins(f, samples.values.min(), samples.values.max()), bins(m, *ends))
    p = joint / joint.sum()
    plain = sum(x * np.log(x / (p[i].sum() * p[:, j].sum())) for (i, j), x in np.ndenumerate(p) if x > 0)
    assert value == pytest.approx(plain, rel=1e-9)


def seen_from(image, sizes, move):
    """An inverted copy of an image, seen through a transformation."""
    out = splines.warp_image(image.chunks, image.sizes, image.chunk, sizes, image.chunk, move)
    return J.Image(B.map_blocks(out, lambda v: (3000 - v).astype("<f4")).persist(), sizes, image.chunk)


def test_levels(spark, moving):
    thin, factors = moving.level(2)
    assert factors == (1, 2, 2) and thin.sizes == (30, 18, 17)
    blurred = kernels.gaussian(whole(moving.chunks, moving.sizes), 1.0)
    assert np.allclose(whole(thin.chunks, thin.sizes), blurred[:, ::2, ::2], atol=1e-2)
    assert moving.level(1)[0] is moving


def test_registration(moving):
    """A planted affine transformation, then a planted field on top of it."""
    sizes = tuple(n - 8 for n in moving.sizes)
    turn = Affine(np.array([[1.02, 0.02, 0], [-0.02, 0.98, 0.02], [0, 0.03, 1.01]]), np.array([4.5, 3.4, 4.4]), (np.array(sizes) - 1) / 2)
    found = J.register_affine(seen_from(moving, sizes, turn), moving, J.Settings(levels=1, turns=30, samples=4000))
    places = splines.grid([0, 0, 0], list(sizes))
    assert np.linalg.norm(found.move(places) - turn(places), axis=0).max() < 0.5
    assert np.linalg.norm(turn(places) - places, axis=0).min() > 4
    still = BSplineField.still(moving.sizes, (14.0, 14.0, 14.0))
    field = BSplineField(np.random.default_rng(5).uniform(-2.5, 2.5, still.grid.shape), still.origin, still.spacing)
    planted = Chain((turn, field))
    found = J.register_bspline(seen_from(moving, sizes, planted), moving, turn, J.Settings(levels=2, turns=20, samples=6000, spacing=(14.0, 14.0, 14.0)))
    inner = splines.grid([2, 2, 2], [n - 4 for n in sizes])
    apart = np.linalg.norm(found.move(turn(inner)) - planted(inner), axis=0)
    assert apart.max() < 1 < np.linalg.norm(planted(inner) - turn(inner), axis=0).max()
    assert found.values[0] < found.values[1]  # the measure rises with the level


def test_settings():
    given = files.parse('// comment\n(NumberOfResolutions 3)\n(NumberOfHistogramBins 64 )\n(FinalGridSpacingInVoxels 10.0 20.0 30.0)\n(Metric "AdvancedMattesMutualInformation")\n')
    assert given["Metric"] == ["AdvancedMattesMutualInformation"]
    assert J.Settings.of(given) == J.Settings(levels=3, bins=64, spacing=(30.0, 20.0, 10.0))
    assert J.Settings.of(files.parse(J.BSPLINE.text())) == J.BSPLINE


def voxels(spark, a):
    return spark.createDataFrame([(*map(int, at), int(v)) for at, v in np.ndenumerate(a)] if a.ndim == 1 else [(int(z), int(y), int(x), int(a[z, y, x])) for z, y, x in np.ndindex(a.shape)], "z int, y int, x int, v bigint")


def test_registered_specimen(spark, tmp_path):
    """A specimen that is the atlas moved by whole voxels: its one cell lands in the right region."""
    atlas = np.rint(smooth((20, 22, 24), 3)).astype(int) + 200
    moved = (2, 1, 3)
    specimen = atlas[2:18, 1:19, 3:23].copy()
    annotation = np.where(np.indices(atlas.shape)[2] < 12, 2, 3)
    own = Config(rough=(1, 1, 1), fine=(1.0, 1.0, 1.0), lower_bound=(5, 0), upper_bound=(9000, 9000), chunk=(16, 16, 16))
    project = Project(str(tmp_path / "s"))
    configs.write(spark, own, project.config)
    pipeline = Pipeline(spark, project)
    settings = {"affine": J.Settings(levels=1, turns=20, samples=4000).text(), "bspline": J.Settings(levels=1, turns=5, samples=4000, spacing=(12.0, 12.0, 12.0)).text()}
    regions = spark.createDataFrame([(1, "w", "w", "000000", None), (2, "a", "a", "000000", 1), (3, "b", "b", "000000", 1)], "id bigint, acronym string, name string, color_hex_triplet string, parent_structure_id bigint")
    ref, annot = pipeline.prepare(voxels(spark, atlas), voxels(spark, annotation).withColumnRenamed("v", "id"), regions, settings)
    bounded = pipeline.bounded(pipeline.trimmed(voxels(spark, specimen)))
    chain = pipeline.transformation(bounded, ref)
    places = splines.grid([0, 0, 0], list(specimen.shape))
    assert np.linalg.norm(chain(places) - (places + np.array(moved)[:, None]), axis=0).max() < 0.5
    assert (pipeline.transformation(bounded, ref)(places) == chain(places)).all()  # read from its files
    seen = whole(pipeline.registered(bounded, ref, chain), specimen.shape)
    inner = (slice(2, -2),) * 3
    assert np.abs(seen[inner] - specimen[inner]).mean() < 0.1 * specimen.std()
    cells = spark.createDataFrame([("c", 5, 5, 8, 1, 1, 1.0), ("d", 5, 5, 10, 1, 1, 1.0)], "cell_id string, z int, y int, x int, count bigint, volume bigint, sum_intensity double")
    trfm = pipeline.cells_transformed(cells, lambda p: move_points(p, chain))
    mapped = pipeline.cells_mapped(cells, trfm, annot, regions)
    assert {r["cell_id"]: r["id"] for r in mapped.collect()} == {"c": 2, "d": 3}
    pipeline.cells_grouped(mapped, regions, csv=False)
    pipeline.stage("mask_regions", lambda: mapped.select("id", *(F.lit(1).alias(c) for c in ("volume_annot", "volume_mask", "volume_prop"))).distinct())
    both = combine(spark, {"s": project})
    assert {r["id"]: r["s__count"] for r in both.where("id > 0").collect()} == {1: 2, 2: 1, 3: 1}
    other = Project(str(tmp_path / "t"))
    configs.write(spark, own.updated(atlas_dir="elsewhere"), other.config)
    with pytest.raises(ValueError):
        combine(spark, {"s": project, "t": other})


def test_volume_cut_short(spark, tmp_path):
    """Voxels that are missing are no zeros: they give no samples and widen no range."""
    import duckdb

    from voxatlas import queries

    # 490 vectors fill 19.6 planes of a body
    spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 490").write.parquet(str(tmp_path / "embeddings.parquet"))
    duckdb.sql(f"create or replace view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    for name in ("mutual_information", "affine_registration"):
        got = sorted(map(tuple, queries.QUERIES[name](spark, str(tmp_path)).collect()))
        assert got == sorted(duckdb.sql(queries.ORACLE_SQL[name]).fetchall()), name


def test_masks(spark):
    a = np.random.default_rng(0).integers(500, 600, (24, 9, 8)).astype("<u2")
    held = np.ones(a.shape, "u1")
    held[20:] = held[:, 7:, 3:] = 0
    sizes, chunk = a.shape, (8, 6, 8)
    image = J.Image(chunked(spark, np.where(held, a, 0).astype("<u2"), chunk), sizes, chunk, chunked(spark, held, chunk))
    assert image.range() == (a[held > 0].min(), a[held > 0].max())
    got = J.sample(image, (1, 1, 1), 10**6)
    assert len(got.values) == image.count() == held.sum()
    assert (got.values == a[tuple(got.places.astype(int))]).all()
    flat = chunked(spark, np.where(held, 700, 0).astype("<u2"), chunk)  # a blur of equal voxels leaves them, up to the ends
    blurred = whole(J.smooth(flat, sizes, chunk, 1.0, image.mask), sizes)
    assert np.abs(blurred[held > 0] - 700).max() < 1e-2
