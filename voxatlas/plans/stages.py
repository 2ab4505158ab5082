"""The staged pipeline: volume to cells, cells to regions, specimens to one table.

A stage reads and writes tables of its project and is skipped where its table exists.
The filters of cell counting are one pass over the blocks, since none of them looks
beyond its block's halo; what later stages share is written.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.operators import cells as C
from voxatlas.operators import chunks as B
from voxatlas.operators import combine as K
from voxatlas.operators import kernels as N
from voxatlas.operators import masks as M
from voxatlas.operators import ontology as O
from voxatlas.operators import rasters as R
from voxatlas.operators import registration as J
from voxatlas.operators import splines as S
from voxatlas.operators import stencils as T
from voxatlas.operators import voxels as V
from voxatlas.operators.kept import kept
from voxatlas.operators.transforms import Chain, move_points
from voxatlas.plans import config as configs
from voxatlas.plans.config import Config
from voxatlas.plans.project import Project
from voxatlas.sources.tables import exists, folders, has_file, is_folder, read_parquet, write_csv, write_parquet
from voxatlas.sources.tiff import read_blocks
from voxatlas.sources.transforms import parse, read_chain, read_text, write_chain, write_text

#: Voxels of a chunk of images that are registered.
REGISTERED_CHUNK = (64, 64, 64)
#: Parameter files of a project's registration.
PARAMETER_FILES = {"affine": "align_affine.txt", "bspline": "align_bspline.txt"}
CELLS_SCHEMA = "label bigint, z bigint, y bigint, x bigint, count bigint, volume bigint, sum_intensity double"


class Pipeline:
    def __init__(self, spark: SparkSession, project: Project, config: Config | None = None, overwrite: bool = False):
        self.spark, self.project, self.overwrite = spark, project, overwrite
        self.config = config or configs.update(spark, project.config)

    def stage(self, name: str, make) -> DataFrame:
        """The table of that name: written by ``make`` unless it is there already."""
        path = self.project.path(name)
        if self.overwrite or not exists(self.spark, path):
            write_parquet(make(), path)
        return read_parquet(self.spark, path)

    # ---- registration images

    def reference(self, name: str, volume: DataFrame) -> DataFrame:
        """A reference or annotation volume, reoriented and trimmed."""
        return self.stage(name, lambda: V.trim(V.reorient(volume, self.config.ref_orient, V.shape(volume)), self.config.ref_trim))

    def rough(self, raw: DataFrame) -> DataFrame:
        return self.stage("downsampled_rough", lambda: V.downsample_rough(raw, self.config.rough))

    def fine(self, rough: DataFrame) -> DataFrame:
        return self.stage("downsampled_fine", lambda: T.resample(rough, self.config.fine, bits=16))

    def trimmed(self, image: DataFrame) -> DataFrame:
        return self.stage("trimmed", lambda: V.trim(image, self.config.trim))

    def bounded(self, image: DataFrame) -> DataFrame:
        c = self.config
        return self.stage("bounded", lambda: image.withColumn("v", V.bound(F.col("v"), c.lower_bound, c.upper_bound)))

    def settings(self, given: dict[str, str] | None = None) -> dict[str, J.Settings]:
        """How images are registered: what the project's parameter files say, which are made of
        ``given`` texts, or of the defaults, where there are none.
        """
        out = {}
        for kind, default in (("affine", J.AFFINE), ("bspline", J.BSPLINE)):
            path = f"{self.project.path('parameters')}/{PARAMETER_FILES[kind]}"
            if not has_file(self.spark, path):
                write_text(self.spark, path, (given or {}).get(kind) or default.text())
            out[kind] = J.Settings.of(parse(read_text(self.spark, path)))
        return out

    def prepare(self, reference: DataFrame, annotation: DataFrame, regions: DataFrame, parameters: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
        """The atlas of the project: reference and annotation, its ontology and its parameter files."""
        self.settings(parameters)
        self.stage("ontology", lambda: regions)
        return self.reference("ref", reference), self.reference("annot", annotation.withColumnRenamed("id", "v")).withColumnRenamed("v", "id")

    def _image(self, voxels: DataFrame) -> J.Image:
        sizes = V.shape(voxels)
        return J.Image(kept(B.from_voxels(voxels, sizes, REGISTERED_CHUNK)), sizes, REGISTERED_CHUNK)

    def transformation(self, fixed: DataFrame, moving: DataFrame) -> Chain:
        """The transformation of the specimen's places into the atlas, found unless its files are there."""
        folder = self.project.path("transform")
        if self.overwrite or not exists(self.spark, folder):
            own = self.settings()
            write_chain(self.spark, J.register(self._image(fixed), self._image(moving), own["affine"], own["bspline"]), folder)
        return read_chain(self.spark, folder)

    def registered(self, fixed: DataFrame, moving: DataFrame, chain: Chain) -> DataFrame:
        """The atlas' image seen from the specimen, in chunks: every voxel reads where the transformation takes it."""
        image = self._image(moving)
        return self.stage("registered", lambda: S.warp_image(image.chunks, image.sizes, image.chunk, V.shape(fixed), REGISTERED_CHUNK, chain, "<u2"))

    # ---- raw data

    def ingest(self, path: str) -> DataFrame:
        """Chunks of a TIFF file or of a folder of slices; nothing else is an image to begin with."""
        if not path.rstrip("/").lower().endswith((".tif", ".tiff")) and not is_folder(self.spark, path):
            raise ValueError(f"{path} is neither a TIFF file nor a folder of slices")
        return read_blocks(self.spark, path, self.config.chunk)

    def tuning(self, raw_chunks: DataFrame) -> "Pipeline":
        """The pipeline of the tuning project, whose raw volume is a box of this one's."""
        out = Pipeline(self.spark, self.project.for_tuning(), self.config, self.overwrite)
        box = V.trim(B.to_voxels(raw_chunks), self.config.tuning_trim)
        out.stage("raw", lambda: B.from_voxels(box, V.shape(box), self.config.chunk))
        return out

    # ---- cell counting

    def overlap(self, raw_chunks: DataFrame, sizes: tuple[int, int, int]) -> DataFrame:
        return self.stage("overlap", lambda: B.add_halo(raw_chunks, sizes, self.config.chunk, self.config.overlap_depth))

    def threshold_filtered(self, overlap: DataFrame) -> DataFrame:
        """Volumes of the bright spots of each block, those out of bounds taken out."""
        c = self.config

        def run(block: np.ndarray) -> np.ndarray:
            v = N.tophat(block, c.tophat_sigma).astype(np.uint16)
            v = np.maximum(N.gaussian(v, c.dog_sigma1) - N.gaussian(v, c.dog_sigma2), 0).astype(np.uint16)
            v = np.maximum(v - N.gaussian(v, c.large_gauss_sigma), 0).astype(np.uint16)
            sizes = N.volumes(N.label(v >= c.threshold))
            return np.where((sizes >= c.min_threshold_size) & (sizes <= c.max_threshold_size), sizes, 0).astype("<u4")

        return self.stage("threshold_filtered", lambda: B.map_blocks(overlap, run))

    def maxima(self, overlap: DataFrame, mask: DataFrame) -> DataFrame:
        size = self.config.maxima_sigma

        def run() -> DataFrame:
            zipped = B.zip_blocks({"overlap": overlap, "mask": B.as_bits(mask)})

            def blocks(frames):
                for row in B.records(frames):
                    found = N.local_maxima(B.block(row, "overlap_payload", "overlap_dtype", "overlap_halo"), size, B.block(row, "mask_payload", "mask_dtype", "mask_halo"))
                    yield B.frame([B.block_row(row, found.astype("u1"), int(row["overlap_halo"]))])

            return zipped.mapInPandas(blocks, B.SCHEMA)

        return self.stage("maxima", run)

    def watershed_volumes(self, overlap: DataFrame, maxima: DataFrame, mask: DataFrame) -> DataFrame:
        """Volumes that the watershed of all maxima gives, halo included; to look at."""
        zipped = B.zip_blocks({"overlap": overlap, "maxima": B.as_bits(maxima), "mask": B.as_bits(mask)})

        def blocks(frames):
            for row in B.records(frames):
                parts = [B.block(row, f"{n}_payload", f"{n}_dtype", f"{n}_halo") for n in ("overlap", "maxima", "mask")]
                grown = N.watershed(parts[0], N.label(parts[1]), parts[2])
                yield B.frame([B.block_row(row, N.volumes(grown).astype("<u4"), int(row["overlap_halo"]))])

        return self.stage("wshed_volumes", lambda: zipped.mapInPandas(blocks, B.SCHEMA))

    def watershed_filtered(self, volumes: DataFrame) -> DataFrame:
        """The watershed's volumes without those out of bounds."""
        least, most = self.config.min_wshed_size or 0, self.config.max_wshed_size or np.iinfo(np.int64).max
        return self.stage("wshed_filtered", lambda: B.map_blocks(volumes, lambda v: np.where((v >= least) & (v <= most), v, 0).astype("<u4")))

    def maxima_labels(self, maxima: DataFrame) -> DataFrame:
        """The maxima of each block numbered by their first voxels, those in the halo too."""
        return self.stage("maxima_labels", lambda: B.map_blocks(maxima, lambda v: N.label(v).astype("<u4")))

    def cells_coords(self, maxima: DataFrame) -> DataFrame:
        """Only where the maxima are: a row for each voxel, measures unknown."""
        return self.stage("cells_coords", lambda: V.nonzero(B.to_voxels(maxima, zeros=False)))

    def cells_from_labels(self, overlap: DataFrame, labels: DataFrame, mask: DataFrame) -> DataFrame:
        """Cells of each block from labels that exist already: those whose first voxel lies in the core."""
        depth = self.config.overlap_depth
        zipped = B.zip_blocks({"overlap": overlap, "labels": labels, "mask": B.as_bits(mask)})
        found = B.blocks_to_table(zipped, ["overlap", "labels", "mask"], lambda *blocks: N.cells_of_labels(*blocks, depth=depth), CELLS_SCHEMA)
        return self.stage("cells_labels", lambda: found.withColumn("cell_id", F.concat_ws("-", *(F.col(c).cast("string") for c in (*B.KEY, "label")))))

    def cells_raw(self, overlap: DataFrame, maxima: DataFrame, mask: DataFrame) -> DataFrame:
        depth = self.config.overlap_depth
        zipped = B.zip_blocks({"overlap": overlap, "maxima": B.as_bits(maxima), "mask": B.as_bits(mask)})

        def cells(block: np.ndarray, maxima: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
            core = block[tuple(slice(depth, n - depth) for n in block.shape)]  # the raw block is the middle of it
            return N.cells(core, block, maxima, mask, depth=depth)

        found = B.blocks_to_table(zipped, ["overlap", "maxima", "mask"], cells, CELLS_SCHEMA)
        kept = C.volume_between(found, self.config.min_wshed_size, self.config.max_wshed_size)
        # a key of its own for each cell: chunk and label
        key = F.concat_ws("-", *(F.col(c).cast("string") for c in (*B.KEY, "label")))
        return self.stage("cells_raw", lambda: kept.withColumn("cell_id", key))

    # ---- cells to regions

    def cells_transformed(self, cells: DataFrame, transform=None) -> DataFrame:
        """Coordinates in the atlas; ``transform`` maps the scaled, trimmed points (cell_id, z, y, x)."""
        c = self.config
        points = C.scale_and_trim(cells.select("cell_id", *C.AXES), c.rough, c.fine, tuple(s[0] for s in c.trim))
        return self.stage("cells_trfm", lambda: transform(points) if transform else points)

    def cells_mapped(self, cells: DataFrame, transformed: DataFrame, annotation: DataFrame, regions: DataFrame, oob: str = "null") -> DataFrame:
        placed = C.region_lookup(C.attach_transformed(cells, transformed), annotation, oob=oob)
        return self.stage("cells", lambda: O.map_ids(placed, O.with_parents(regions)))

    def cells_grouped(self, cells: DataFrame, regions: DataFrame, csv: bool = True) -> DataFrame:
        out = self.stage("cells_agg", lambda: O.group_cells(cells, regions))
        if csv:
            write_csv(out, self.project.path("cells_agg_csv"))
        return out

    # ---- mask

    def mask_regions(self, image: DataFrame, annotation: DataFrame, whole_annotation: DataFrame, regions: DataFrame, transform=None) -> DataFrame:
        """Share of each region that the specimen covers.

        The mask's outline goes through the point transformation, is filled again in
        the atlas, closed and opened, and counted by region.
        """
        c = self.config
        sizes = V.shape(annotation)
        events = M.outline(V.manual_threshold(T.gaussian_blur(image, c.mask_gauss_blur), c.mask_threshold))
        moved = transform(events) if transform else events
        rounded = moved.withColumns({a: F.rint(a).cast("int") for a in C.AXES}).where(C.in_bounds(sizes))
        outline = self.stage("mask_outline", lambda: rounded)
        self.stage("mask_code", lambda: M.outline_code(outline))
        filled = self.stage("mask_fill", lambda: T.binary_open(T.binary_close(M.fill(outline, sizes[2]).distinct(), sizes), sizes))
        return self.stage("mask_regions", lambda: M.coverage(filled, annotation, whole_annotation, regions))

    # ---- pictures of the cells

    def visual_checks(self, cells_raw: DataFrame, raw_shape, cells_trfm: DataFrame, atlas_shape) -> dict[str, DataFrame]:
        c = self.config
        return {
            "points_raw": self.stage("points_raw", lambda: R.points_distinct(cells_raw, raw_shape)),
            "heatmap_raw": self.stage("heatmap_raw", lambda: R.heatmap_strict(cells_raw, raw_shape, c.heatmap_raw_radius)),
            "points_trfm": self.stage("points_trfm", lambda: R.points_distinct(cells_trfm, atlas_shape)),
            "heatmap_trfm": self.stage("heatmap_trfm", lambda: R.heatmap_strict(cells_trfm, atlas_shape, c.heatmap_trfm_radius)),
        }

    def trimmed_to_final(self, blocks: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Block artefacts (maxima, threshold, wshed) as voxels, without halos, in the box that pictures show."""
        return {name: self.stage(f"{name}_final", lambda df=df: V.trim(B.to_voxels(df), self.config.combine_cellc_trim)) for name, df in blocks.items()}

    def stacked(self, name: str, images: list[DataFrame]) -> DataFrame:
        """Images of one shape as the channels of a picture."""
        return self.stage(f"stack_{name}", lambda: V.stack_channels(images))

    # ---- everything

    def count_cells(self, raw_chunks: DataFrame) -> dict[str, DataFrame]:
        """The stages of cell counting, from raw chunks to cells."""
        first = raw_chunks.agg(*(F.max(F.col(f"{a}0") + F.col(f"n{a}")) for a in V.AXES)).head()
        out = {"overlap": self.overlap(raw_chunks, tuple(int(n) for n in first))}
        out["threshold"] = self.threshold_filtered(out["overlap"])
        out["maxima"] = self.maxima(out["overlap"], out["threshold"])
        out["wshed"] = self.watershed_filtered(self.watershed_volumes(out["overlap"], out["maxima"], out["threshold"]))
        out["cells"] = self.cells_raw(out["overlap"], out["maxima"], out["threshold"])
        return out

    def run(self, raw: DataFrame | str, annotation: DataFrame, regions: DataFrame, transform=None, reference: DataFrame | None = None, *, mask: bool = True, tuning: bool = True, visual: bool = False) -> DataFrame:
        """From raw voxels, or the path of an image, to the region table of one specimen.

        Raw data, images for registration, the coverage mask, counting on the tuning box
        and on everything, mapping and grouping; with ``visual`` pictures too.
        ``transform`` moves points of the trimmed image into the atlas.  Without one, but
        with the atlas' ``reference`` image, the specimen is registered to that.
        """
        def ingest() -> DataFrame:
            return self.ingest(raw) if isinstance(raw, str) else B.from_voxels(raw, V.shape(raw), self.config.chunk)

        raw_chunks = self.stage("raw", ingest)
        whole = annotation
        register = transform is None and reference is not None
        atlas, annotation = self.prepare(reference if reference is not None else whole.withColumnRenamed("id", "v"), annotation, regions)
        if mask or visual or register:
            trimmed = self.trimmed(self.fine(self.rough(B.to_voxels(raw_chunks))))
            bounded = self.bounded(trimmed)
        if register:
            chain = self.transformation(bounded, atlas)
            seen = self.registered(bounded, atlas, chain)
            transform = lambda points: move_points(points, chain)
        if mask:
            self.mask_regions(bounded, annotation, whole, regions, transform)
        if tuning:
            part = self.tuning(raw_chunks)
            part.count_cells(read_parquet(self.spark, part.project.path("raw")))
        found = self.count_cells(raw_chunks)
        moved = self.cells_transformed(found["cells"], transform)
        cells = self.cells_mapped(found["cells"], moved, annotation, regions)
        if visual:
            raw_shape, atlas_shape = V.shape(B.to_voxels(raw_chunks)), V.shape(annotation)
            pictures = self.visual_checks(found["cells"], raw_shape, moved, atlas_shape)
            final = self.trimmed_to_final({name: found[name] for name in ("maxima", "threshold", "wshed")})
            box = V.trim(B.to_voxels(raw_chunks), self.config.combine_cellc_trim)
            if register:
                self.stacked("registration", [trimmed, bounded, B.to_voxels(seen)])
            self.stacked("cells", [box, final["threshold"], final["wshed"]])
            self.stacked("points", [atlas, annotation.withColumnRenamed("id", "v"), R.dense(pictures["heatmap_trfm"], atlas_shape)])
        return self.cells_grouped(cells, regions)


def combine(spark: SparkSession, projects: dict[str, Project], regions: DataFrame | None = None, path: str | None = None, overwrite: bool = False) -> DataFrame:
    """The combined table of specimens, which must have been made with the same atlas.

    Without ``regions`` the ontology is the one that the first project has kept.

    With ``path`` it is written there, as parquet and as csv with rows of specimens and of
    measures on top, unless it is there already.
    """
    if not projects:
        raise ValueError("no specimens")
    if path and not overwrite and exists(spark, f"{path}/combined"):
        return read_parquet(spark, f"{path}/combined")
    versions = {name: configs.read(spark, p.config) for name, p in projects.items()}
    if len({(c.atlas_dir, c.ref_version, c.annot_version, c.map_version) for c in versions.values()}) > 1:
        raise ValueError("the specimens were made with different atlases")
    if regions is None:
        regions = read_parquet(spark, next(iter(projects.values())).path("ontology"))
    tables = {name: K.specimen_table(read_parquet(spark, p.path("cells_agg")), read_parquet(spark, p.path("mask_regions"))) for name, p in projects.items()}
    out = K.combine_wide(K.annotations(spark, regions), tables)
    if path:
        out = write_parquet(out, f"{path}/combined")
        write_csv(K.with_two_headers(out), f"{path}/combined_csv", header=False)
    return out


def combine_folder(spark: SparkSession, root: str, regions: DataFrame | None, path: str, overwrite: bool = False) -> DataFrame:
    """The combined table of all projects right below ``root``: the folders that have parameters."""
    found = {p.rstrip("/").rsplit("/", 1)[-1]: Project(p) for p in folders(spark, root)}
    return combine(spark, {name: p for name, p in found.items() if configs.found(spark, p.config)}, regions, path, overwrite)


def run_all(specimens: dict[str, object]) -> dict[str, Exception]:
    """Run each specimen's callable; one that fails does not stop the others."""
    failed = {}
    for name, run in specimens.items():
        try:
            run()
        except Exception as error:  # noqa: BLE001 - reported by specimen
            failed[name] = error
    return failed
