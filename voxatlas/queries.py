"""Registered queries of the volumetric operators, each over whole tables, with DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas import fixtures as fx
from voxatlas.functions import scalar
from voxatlas.operators import cells as C
from voxatlas.operators import chunks as B
from voxatlas.operators import combine as K
from voxatlas.operators import kernels as N
from voxatlas.operators import masks as M
from voxatlas.operators import ontology as O
from voxatlas.operators import rasters as R
from voxatlas.operators import registration as J
from voxatlas.operators import segments as G
from voxatlas.operators import splines as S
from voxatlas.operators import stencils as T
from voxatlas.operators import voxels as V
from voxatlas.operators import warps as P
from voxatlas.operators.kept import kept, shared_path
from voxatlas.operators.numbering import numbered
from voxatlas.operators.transforms import Affine, BSplineField, Chain, move_points
from voxatlas.sources.transforms import read_chain, write_chain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: DuckDB definitions of the stand-ins.
VOX = "vox as (select vec_id::int as z, ((i - 1) // 8)::int as y, ((i - 1) % 8)::int as x, floor((embedding[i]::double + 1.0) * 1000)::bigint as v from embeddings, range(1, 65) r(i))"
ONT = """ont as (
    select 1::bigint as id, 'world' as name, null::bigint as parent union all
    select (10 + r_regionkey)::bigint, r_name, 1 from region union all
    select (100 + n_nationkey)::bigint, n_name, 10 + n_regionkey from nation union all
    select 100000 + s_suppkey, s_name, 100 + s_nationkey from supplier)"""
CELLS = """cells as (
    select l_returnflag as specimen, 1::bigint as count, l_quantity::bigint as volume, round_even(l_extendedprice * 100, 0)::bigint as sum_intensity,
        l_linenumber::int as z, (l_suppkey % 16)::int as y, (l_partkey % 32)::int as x,
        (case when l_linenumber = 7 then 0 when l_linenumber = 6 and l_returnflag = 'R' then -1 when l_linenumber = 5 and l_returnflag = 'A' then 999
            when l_linestatus = 'O' then 100 + s_nationkey else 100000 + l_suppkey end)::bigint as id
    from lineitem join supplier on l_suppkey = s_suppkey)"""
ANNOT = "annot as (select z::int as z, y::int as y, x::int as x, (case when (x + y) % 5 = 0 then 0 else 100 + (z * 7 + y * 3 + x) % 25 end)::bigint as id from range(8) a(z), range(16) b(y), range(32) c(x))"
#: Each region with itself and everything below it.
TREE = "tree(ancestor, id) as (select id, id from ont union all select t.ancestor, o.id from tree t join ont o on o.parent = t.id)"


def with_(*parts: str, recursive: bool = False) -> str:
    return "with " + "recursive " * recursive + ", ".join(parts) + " "


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return register


# ---- ontology and cells -------------------------------------------------------------

ROLLUP = with_(
    ONT,
    CELLS,
    TREE,
    "own as (select id, sum(count) as count, sum(volume) as volume, sum(sum_intensity) as sum_intensity from cells group by id)",
    "ids as (select id from ont union select id from own)",
    "paths as (select * from tree union all select id, id from own where id not in (select id from ont))",
    recursive=True,
)


@query(
    "rollup_nested_regions",
    ROLLUP
    + """select i.id, o.name, o.parent as parent_structure_id, p.name as parent_acronym,
    coalesce(sum(w.count), 0)::bigint as count, coalesce(sum(w.volume), 0)::bigint as volume, coalesce(sum(w.sum_intensity), 0)::bigint as sum_intensity,
    round(coalesce(sum(w.sum_intensity), 0)::double / nullif(coalesce(sum(w.volume), 0), 0), 6) as iov
    from ids i left join ont o on i.id = o.id left join ont p on o.parent = p.id left join paths t on t.ancestor = i.id left join own w on w.id = t.id
    group by all""",
)
def rollup_nested_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = O.group_cells(fx.cells(spark, sf_dir), fx.regions(spark, sf_dir))
    return out.select("id", "name", "parent_structure_id", "parent_acronym", "count", "volume", "sum_intensity", F.round("iov", 6).alias("iov"))


@query("ontology_flatten_parents", with_(ONT) + "select o.id, o.name, o.parent as parent_structure_id, p.name as parent_acronym from ont o left join ont p on o.parent = p.id")
def ontology_flatten_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.with_parents(fx.regions(spark, sf_dir)).select("id", "name", "parent_structure_id", "parent_acronym")


@query("ontology_children", with_(ONT) + "select o.id, coalesce((select string_agg(c.id::varchar, ',' order by c.id) from ont c where c.parent = o.id), '') as children from ont o")
def ontology_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.with_children(fx.regions(spark, sf_dir)).select("id", F.array_join(F.transform("children", lambda c: c.cast("string")), ",").alias("children"))


@query("ontology_closure", with_(ONT, TREE, recursive=True) + "select id, ancestor from tree")
def ontology_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.closure(fx.regions(spark, sf_dir))


@query(
    "map_ids_special_names",
    with_(ONT, CELLS)
    + "select c.specimen, c.z, c.y, c.x, c.id, case c.id when -1 then 'invalid' when 0 then 'universe' else coalesce(o.name, 'no_label') end as name, sum(c.volume)::bigint as volume from cells c left join ont o on c.id = o.id group by all",
)
def map_ids_special_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.map_ids(fx.cells(spark, sf_dir), fx.regions(spark, sf_dir)).groupBy("specimen", "z", "y", "x", "id", "name").agg(F.sum("volume").alias("volume"))


@query("group_cells", with_(CELLS) + "select id, sum(count)::bigint as count, sum(volume)::bigint as volume, sum(sum_intensity)::bigint as sum_intensity from cells group by id")
def group_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.cells(spark, sf_dir).where("id is not null").groupBy("id").agg(*(F.sum(m).alias(m) for m in O.MEASURES))


@query(
    "coords_transform_scale_trim",
    with_(CELLS) + "select specimen, z, y, x, round(z / 3.0::double * 1.0 - 0, 9) as zt, round(y / 6.0::double * 0.6::double - 1, 9) as yt, round(x / 6.0::double * 0.6::double - 2, 9) as xt, count(*) as n from cells group by all",
)
def coords_transform_scale_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = fx.cells(spark, sf_dir)
    moved = C.scale_and_trim(cells.select("specimen", *(F.col(a).alias(f"{a}0") for a in C.AXES), *C.AXES), (3, 6, 6), (1.0, 0.6, 0.6), (None, 1, 2))
    return moved.select("specimen", *(F.col(f"{a}0").alias(a) for a in C.AXES), *(F.round(a, 9).alias(f"{a}t") for a in C.AXES)).groupBy("specimen", "z", "y", "x", "zt", "yt", "xt").agg(F.count("*").alias("n"))


def _lookup(spark: SparkSession, sf_dir: str, oob: str) -> DataFrame:
    cells = fx.cells(spark, sf_dir).withColumns({"z_trfm": F.col("z") + F.lit(2.5), "y_trfm": F.col("y") + F.lit(0.25), "x_trfm": F.col("x").cast("double")})
    return C.region_lookup(cells, fx.annotation(spark), oob=oob).groupBy("id").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


LOOKUP = with_(CELLS, ANNOT) + "select {} as id, count(*) as n, sum(c.volume)::bigint as volume from cells c left join annot a on round_even(c.z + 2.5, 0)::int = a.z and c.y = a.y and c.x = a.x group by all"


@query("cell_region_lookup", LOOKUP.format("a.id"))
def cell_region_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "null")


@query("cell_region_lookup_invalid", LOOKUP.format("coalesce(a.id, -1)"))
def cell_region_lookup_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lookup(spark, sf_dir, "invalid")


@query("cell_volume_filter", with_(CELLS) + "select specimen, id, count(*) as n from cells where volume between 5 and 40 group by all")
def cell_volume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.volume_between(fx.cells(spark, sf_dir), 5, 40).groupBy("specimen", "id").agg(F.count("*").alias("n"))


# ---- several specimens --------------------------------------------------------------

SPECIMENS = ("A", "N", "R")


def _specimens(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Cell sums and mask shares for each specimen, small integers throughout."""
    out = {}
    for s in SPECIMENS:
        own = fx.cells(spark, sf_dir).where(F.col("specimen") == s).groupBy("id").agg(*(F.sum(m).alias(m) for m in O.MEASURES)).withColumn("iov", F.round(F.try_divide(F.col("sum_intensity").cast("double"), F.col("volume").cast("double")), 6))
        mask = fx.cells(spark, sf_dir).where((F.col("specimen") == s) & (F.col("z") < 4)).groupBy("id").agg(F.count("*").alias("volume_annot"), F.sum((F.col("volume") > 25).cast("bigint")).alias("volume_mask"))
        out[s] = K.specimen_table(own, mask.withColumn("volume_prop", F.round(F.try_divide(F.col("volume_mask").cast("double"), F.col("volume_annot").cast("double")), 6)))
    return out


SPEC = """spec as (
    select coalesce(a.id, m.id) as id, coalesce(a.specimen, m.specimen) as specimen, count, volume, sum_intensity, round(sum_intensity::double / nullif(volume, 0), 6) as iov,
        volume_annot, volume_mask, round(volume_mask::double / nullif(volume_annot, 0), 6) as volume_prop
    from (select specimen, id, sum(count)::bigint as count, sum(volume)::bigint as volume, sum(sum_intensity)::bigint as sum_intensity from cells group by all) a
    full join (select specimen, id, count(*) as volume_annot, sum((volume > 25)::bigint)::bigint as volume_mask from cells where z < 4 group by all) m on a.id = m.id and a.specimen = m.specimen)"""


@query(
    "combine_specimens_long",
    with_(CELLS, SPEC) + " union all ".join(f"select id, specimen, '{m}' as measure, {m}::double as value from spec where {m} is not null" for m in K.MEASURES),
)
def combine_specimens_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.combine_long(_specimens(spark, sf_dir))


@query(
    "combine_specimens_wide",
    with_(ONT, CELLS, SPEC, "notes as (select o.id, o.name, o.parent, p.name as parent_name from ont o left join ont p on o.parent = p.id union all select -1, 'invalid', null, null union all select 0, 'universe', null, null)")
    + ", ".join(["select coalesce(n.id, s.id) as id, n.name, n.parent as parent_structure_id, n.parent_name as parent_acronym", *(f"s.{k}__{m}" for k in SPECIMENS for m in K.MEASURES)])
    + " from notes n full join (select id, "
    + ", ".join(f"max({m}) filter (specimen = '{k}') as {k}__{m}" for k in SPECIMENS for m in K.MEASURES)
    + " from spec group by id) s on n.id = s.id",
)
def combine_specimens_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = K.combine_wide(K.annotations(spark, fx.regions(spark, sf_dir)), _specimens(spark, sf_dir))
    return wide.drop("acronym", "color_hex_triplet")


# ---- masks --------------------------------------------------------------------------

LEVEL = 1000
MASK = f"mask as (select z, y, x, (v >= {LEVEL})::int as v from vox)"


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.manual_threshold(fx.volume(spark, sf_dir), LEVEL)


EVENTS = """events as (
    select m.z, m.y, m.x, 1 as is_in, 0 as seq from mask m left join mask l on l.z = m.z and l.y = m.y and l.x = m.x - 1 where m.v = 1 and coalesce(l.v, 0) = 0
    union all select m.z, m.y, m.x, 0, 1 from mask m left join mask r on r.z = m.z and r.y = m.y and r.x = m.x + 1 where m.v = 1 and coalesce(r.v, 0) = 0)"""


@query("mask_outline", with_(VOX, MASK, EVENTS) + "select * from events")
def mask_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.outline(_mask(spark, sf_dir))


@query("mask_fill_outline", with_(VOX, MASK) + "select z, y, x from mask where v = 1")
def mask_fill_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.fill(M.outline(_mask(spark, sf_dir)), 8)


@query("mask_outline_code", with_(VOX, MASK, EVENTS) + "select z, y, x, (max(is_in) + 2 * max(1 - is_in))::int as v from events group by all")
def mask_outline_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.outline_code(M.outline(_mask(spark, sf_dir)))


@query("mask_region_counts", with_(VOX, MASK, ANNOT) + "select a.id, count(*) as volume from mask m join annot a using (z, y, x) where m.v > 0 and a.id <> 0 group by a.id")
def mask_region_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.region_counts(_mask(spark, sf_dir).where("v > 0"), fx.annotation(spark))


@query(
    "mask_volume_prop",
    with_(
        VOX,
        MASK,
        ANNOT,
        ONT,
        TREE,
        "own as (select a.id, count(*) as va, sum(coalesce(m.v, 0)) as vm from annot a left join mask m using (z, y, x) where a.id <> 0 group by a.id)",
        recursive=True,
    )
    + "select t.ancestor as id, coalesce(sum(va), 0)::bigint as volume_annot, coalesce(sum(vm), 0)::bigint as volume_mask, round(coalesce(sum(vm), 0)::double / nullif(coalesce(sum(va), 0), 0), 6) as volume_prop from tree t left join own w on w.id = t.id group by all",
)
def mask_volume_prop(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = fx.annotation(spark)
    out = M.coverage(_mask(spark, sf_dir).where("v > 0"), grid, grid, fx.regions(spark, sf_dir))
    return out.select("id", "volume_annot", "volume_mask", F.round("volume_prop", 6).alias("volume_prop"))


# ---- points into volumes ------------------------------------------------------------

SHAPE = (7, 15, 30)
POINTS = "points as (select z + 0.5::double as z, y + 0.25::double as y, x - 0.5::double as x, id, sum_intensity from cells)"
INSIDE = "z between 0 and 6 and y between 0 and 14 and x between 0 and 29"
ROUNDED = "rounded as (select round_even(z, 0)::int as z, round_even(y, 0)::int as y, round_even(x, 0)::int as x, id, sum_intensity from points)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.cells(spark, sf_dir).select((F.col("z") + F.lit(0.5)).alias("z"), (F.col("y") + F.lit(0.25)).alias("y"), (F.col("x") - F.lit(0.5)).alias("x"), "id", "sum_intensity")


@query("points_distinct", with_(CELLS, POINTS, ROUNDED) + f"select distinct z, y, x, 1 as v from rounded where {INSIDE}")
def points_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.points_distinct(_points(spark, sf_dir), SHAPE)


@query("points_count", with_(CELLS, POINTS, ROUNDED) + f"select z, y, x, count(*) as v from rounded where {INSIDE} group by all")
def points_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.points_count(_points(spark, sf_dir), SHAPE)


BALL = "ball as (select a.i as dz, b.i as dy, c.i as dx from range(-{r}, {r} + 1) a(i), range(-{r}, {r} + 1) b(i), range(-{r}, {r} + 1) c(i) where sqrt(a.i * a.i + b.i * b.i + c.i * c.i) {op} {r})"


@query(
    "heatmap_strict",
    with_(CELLS, POINTS, BALL.format(r=3, op="<"), "spots as (select distinct z, y, x from points)")
    + f"select z, y, x, count(*) as v from (select distinct round_even(p.z + dz, 0)::int as z, round_even(p.y + dy, 0)::int as y, round_even(p.x + dx, 0)::int as x, dz, dy, dx from spots p, ball) where {INSIDE} group by z, y, x",
)
def heatmap_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.heatmap_strict(_points(spark, sf_dir), SHAPE, 3)


@query(
    "heatmap_inclusive",
    with_(CELLS, POINTS, ROUNDED, BALL.format(r=3, op="<="), "spots as (select z, y, x, count(*) as n from rounded where z > -3 and z < 10 and y > -3 and y < 18 and x > -3 and x < 33 group by all)")
    + f"select z, y, x, sum(n)::bigint as v from (select (p.z + dz)::int as z, (p.y + dy)::int as y, (p.x + dx)::int as x, n from spots p, ball) where {INSIDE} group by z, y, x",
)
def heatmap_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.heatmap_inclusive(_points(spark, sf_dir), SHAPE, 3)


@query("paint_regions", with_(CELLS, POINTS, ROUNDED) + f"select z, y, x, arg_max(id, sum_intensity * 1000000 + id) as id from rounded where {INSIDE} group by z, y, x")
def paint_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.paint_regions(_points(spark, sf_dir).withColumn("seq", F.col("sum_intensity") * 1000000 + F.col("id")), SHAPE, order="seq")


# ---- slices and pointwise operators -------------------------------------------------

TOP = "top as (select max(z) + 1 as n from vox)"


@query("slice_trim", with_(VOX, TOP) + "select ((z - 10) // 3)::int as z, (y - 1)::int as y, (6 - x)::int as x, v from vox, top where z >= 10 and z < n - 5 and (z - 10) % 3 = 0 and y >= 1 and y < 7 and x <= 6 and x > 1")
def slice_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.trim(fx.volume(spark, sf_dir), ((10, -5, 3), (1, -1, None), (6, 1, -1)))


@query("downsample_rough", with_(VOX) + "select (z // 3)::int as z, (y // 2)::int as y, (x // 2)::int as x, v from vox where z % 3 = 0 and y % 2 = 0 and x % 2 = 0")
def downsample_rough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.downsample_rough(fx.volume(spark, sf_dir), (3, 2, 2))


@query("reorient", with_(VOX, TOP) + "select y as z, (7 - x)::int as y, (n - 1 - z)::int as x, v from vox, top")
def reorient(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    return V.reorient(volume, (2, -3, -1), V.shape(volume))


@query("bound_intensity", with_(VOX) + "select z, y, x, (case when (case when v < 950 then 0 else v end) > 1100 then 5000 else (case when v < 950 then 0 else v end) end)::bigint as v from vox")
def bound_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.volume(spark, sf_dir).withColumn("v", V.bound(F.col("v"), (950, 0), (1100, 5000)).cast("bigint"))


@query("clip_intensity", with_(VOX) + "select z, y, x, least(greatest(v, 900), 1100)::bigint as v from vox")
def clip_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.volume(spark, sf_dir).withColumn("v", V.clip(F.col("v"), 900, 1100).cast("bigint"))


@query("volume_filter", with_(VOX) + "select z, y, x, (case when v between 900 and 1100 then v else 0 end)::bigint as v from vox")
def volume_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.volume_filter(fx.volume(spark, sf_dir), 900, 1100)


@query("apply_mask", with_(VOX) + "select z, y, x, (case when (v % 300) % 256 > 0 then v else 0 end)::bigint as v from vox")
def apply_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    return V.apply_mask(volume, volume.withColumn("v", F.col("v") % 300)).withColumn("v", F.col("v").cast("bigint"))


@query("stack_channels", with_(VOX) + "select z, y, x, least(greatest(v, 0), 65535)::int as c0, least(greatest(round_even((v - 1000) * 0.5::double, 0), 0), 65535)::int as c1, least(v * 60, 65535)::int as c2 from vox")
def stack_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    return V.stack_channels([volume, volume.withColumn("v", (F.col("v") - 1000) * F.lit(0.5)), volume.withColumn("v", F.col("v") * 60)])


@query("nonzero_coords", with_(VOX) + "select v as label, z, y, x, -1 as volume, -1 as sum_intensity from (select z, y, x, case when v < 1000 then 0 else v end as v from vox) where v <> 0")
def nonzero_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.nonzero(fx.volume(spark, sf_dir).withColumn("v", F.when(F.col("v") < 1000, 0).otherwise(F.col("v")).cast("bigint")))


@query("manual_threshold", with_(VOX) + "select z, y, x, (v >= 1050)::int as v from vox")
def manual_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.manual_threshold(fx.volume(spark, sf_dir), 1050)


@query("mean_threshold", with_(VOX, "s as materialized (select count(*)::hugeint as n, sum(v)::hugeint as s, sum(v * v)::hugeint as q from vox where v > 0)") + "select z, y, x, (v * n > s and (v * n - s) * (v * n - s) > n * q - s * s)::int as v from (select z, y, x, v::hugeint as v, (select n from s) as n, (select s from s) as s, (select q from s) as q from vox)")
def mean_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.mean_threshold(fx.volume(spark, sf_dir), 1)


OTSU = (
    "ends as (select min(v)::double as lo, max(v)::double as hi from vox)",
    "bins as (select least(floor((v - lo) / ((hi - lo) / 256)), 255)::bigint as bin, count(*) as n from vox, ends group by all)",
    "parts as (select a.bin, sum(b.n) filter (b.bin <= a.bin) as w, sum(b.n * b.bin) filter (b.bin <= a.bin) as s, sum(b.n) as wt, sum(b.n * b.bin) as st from bins a, bins b group by a.bin)",
    "best as (select bin from parts order by coalesce((wt * s - st * w)::double * (wt * s - st * w)::double / nullif((w * (wt - w))::double, 0), 0) desc, bin limit 1)",
)


@query("otsu_threshold", with_(VOX, *OTSU) + "select z, y, x, (v > lo + (bin + 1) * ((hi - lo) / 256))::int as v from vox, best, ends")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.otsu_threshold(fx.volume(spark, sf_dir), mode="edge")


@query("otsu_threshold_index", with_(VOX, *OTSU) + "select z, y, x, (v > bin)::int as v from vox, best")
def otsu_threshold_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.otsu_threshold(fx.volume(spark, sf_dir), mode="index")


@query(
    "intensity_histogram",
    with_(VOX, "b as (select least(floor(v::double / (5000.0::double / 256)), 255)::int as bin, count(*) as n from vox where v between 0 and 5000 group by all)")
    + "select round(r.i * (5000.0::double / 256), 9) as left_edge, round(coalesce(b.n, 0) / ((select sum(n) from b) * (5000.0::double / 256)), 12) as density from range(256) r(i) left join b on b.bin = r.i",
)
def intensity_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.density_histogram(fx.volume(spark, sf_dir)).select(F.round("left", 9).alias("left_edge"), F.round("density", 12).alias("density"))


# ---- stencils -----------------------------------------------------------------------


def _reflect(c: str, n: str) -> str:
    """A place beyond the ends, mirrored with the edge included."""
    m = f"((({c}) % (2 * {n}) + 2 * {n}) % (2 * {n}))"
    return f"(case when {m} < {n} then {m} else 2 * {n} - 1 - {m} end)"


def _ranked_sql(name: str, source: str, axis: str, low: int, high: int, best: str) -> str:
    n = "(select n from top)" if axis == "z" else "8"
    others = [a for a in "zyx" if a != axis]
    return f"{name} as (select a.{others[0]}, a.{others[1]}, a.{axis}, {best}(b.v) as v from {source} a, range({low}, {high} + 1) o(d), {source} b where b.{others[0]} = a.{others[0]} and b.{others[1]} = a.{others[1]} and b.{axis} = {_reflect(f'a.{axis} + o.d', n)} group by all)"


def _window_sql(prefix: str, source: str, size: int, best: str, mirror: bool = False) -> list[str]:
    low, high = T.window(size, mirror)
    out = []
    for axis in "zyx":
        out.append(_ranked_sql(f"{prefix}{axis}", source, axis, low, high, best))
        source = f"{prefix}{axis}"
    return out


@query("max_filter", with_(VOX, TOP, *_window_sql("m", "vox", 4, "max")) + "select z, y, x, v from mx")
def max_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.max_filter(fx.volume(spark, sf_dir), 4)


@query("tophat", with_(VOX, TOP, *_window_sql("e", "vox", 4, "min"), *_window_sql("d", "ex", 4, "max", True)) + "select a.z, a.y, a.x, greatest(a.v - b.v, 0)::bigint as v from vox a join dx b using (z, y, x)")
def tophat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.tophat(fx.volume(spark, sf_dir), 4)


@query("local_maxima", with_(VOX, TOP, *_window_sql("m", "vox", 4, "max")) + "select a.z, a.y, a.x, (a.v = b.v and a.v >= 1000)::int as v from vox a join mx b using (z, y, x)")
def local_maxima(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    return T.local_maxima(volume, 4, V.manual_threshold(volume, 1000))


def _resample_sql(name: str, source: str, axis: str, zoom: float) -> str:
    n = "(select n from top)" if axis == "z" else "8"
    a, b = (c for c in "zyx" if c != axis)
    places = f"select j::int as j, (j * (n - 1)) // greatest(m - 1, 1) as i, ((j * (n - 1)) % greatest(m - 1, 1))::double / greatest(m - 1, 1) as f, n from (select n, m, unnest(range(m)) as j from (select {n} as n, greatest(round_even({n} * {zoom}::double, 0), 1)::bigint as m))"
    return f"{name} as (select o.j as {axis}, p.{a}, p.{b}, p.v + (q.v - p.v) * o.f as v from ({places}) o join {source} p on p.{axis} = o.i join {source} q on q.{axis} = least(o.i + 1, o.n - 1) and q.{a} = p.{a} and q.{b} = p.{b})"


@query(
    "downsample_linear",
    with_(VOX, TOP, "flat as (select z, y, x, v::double as v from vox)", _resample_sql("fz", "flat", "z", 0.7), _resample_sql("fy", "fz", "y", 0.6), _resample_sql("fx", "fy", "x", 0.6))
    + "select z, y, x, round(v, 6) as v from fx",
)
def downsample_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.resample(fx.volume(spark, sf_dir), (0.7, 0.6, 0.6), order=1).withColumn("v", F.round("v", 6))


def _spline_sql(name: str, source: str, axis: str, zoom: float) -> list[str]:
    """Coefficients of the spline at all old places, then the four of them around each new one."""
    n = "(select n from top)" if axis == "z" else "8::bigint"
    a, b = (c for c in "zyx" if c != axis)
    mirror = "(case when {0} % (2 * (n - 1)) > n - 1 then 2 * (n - 1) - {0} % (2 * (n - 1)) else {0} % (2 * (n - 1)) end)"
    t = "abs(j * (n - 1) / (m - 1)::double - k)"
    return [
        f"{name}_c as (select w.k as {axis}, p.{a}, p.{b}, sum(p.v * w.w) as v from (select k, {mirror.format('(k + d + 200 * (n - 1))')} as i, sum(sqrt(3) * pow(sqrt(3) - 2, abs(d))) as w from (select n, unnest(range(n)) as k from (select {n} as n)), range(-45, 46) s(d) group by all) w join {source} p on p.{axis} = w.i group by all)",
        f"{name} as (select w.j::int as {axis}, p.{a}, p.{b}, sum(p.v * w.w) as v from (select j, {mirror.format('(k + 2 * (n - 1))')} as i, case when {t} < 1 then 2 / 3.0::double - {t} * {t} + pow({t}, 3) / 2 else pow(greatest(2 - {t}, 0), 3) / 6 end as w from (select *, j * (n - 1) // (m - 1) + d as k from (select n, m, unnest(range(m)) as j from (select {n} as n, round_even({n} * {zoom}::double, 0)::bigint as m)), range(-1, 3) s(d))) w join {name}_c p on p.{axis} = w.i group by all)",
    ]


@query(
    "downsample_fine",
    with_(VOX, TOP, "flat as (select z, y, x, v::double as v from vox)", *_spline_sql("fz", "flat", "z", 0.7), *_spline_sql("fy", "fz", "y", 0.6), *_spline_sql("fx", "fy", "x", 0.6))
    + "select z, y, x, round(v, 5) as v from fx",
)
def downsample_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.resample(fx.volume(spark, sf_dir), (0.7, 0.6, 0.6)).withColumn("v", F.round("v", 5))


UNIT = 1000


def _blur_sql(prefix: str, sigma: float) -> list[str]:
    weights = T.gaussian_weights(sigma, unit=UNIT)
    r = len(weights) // 2
    values = ", ".join(f"({k - r}, {w}::bigint)" for k, w in enumerate(weights))
    out, source = [], "vox"
    for axis in "zyx":
        n = "(select n from top)" if axis == "z" else "8"
        others = [a for a in "zyx" if a != axis]
        out.append(
            f"{prefix}{axis} as (select a.{others[0]}, a.{others[1]}, a.{axis}, sum(b.v::bigint * o.w)::bigint as v from {source} a, (values {values}) o(d, w), {source} b where b.{others[0]} = a.{others[0]} and b.{others[1]} = a.{others[1]} and b.{axis} = {_reflect(f'a.{axis} + o.d', n)} group by all)"
        )
        source = f"{prefix}{axis}"
    return [*out, f"{prefix} as (select z, y, x, v // {UNIT**3} as v from {source})"]


@query("gauss_blur_int", with_(VOX, TOP, *_blur_sql("g", 2)) + "select z, y, x, v from g")
def gauss_blur_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.gaussian_blur(fx.volume(spark, sf_dir), 2, unit=UNIT)


@query("dog_int", with_(VOX, TOP, *_blur_sql("g", 1), *_blur_sql("h", 2)) + "select z, y, x, greatest(g.v - h.v, 0)::bigint as v from g join h using (z, y, x)")
def dog_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.difference_of_gaussians(fx.volume(spark, sf_dir), 1, 2, unit=UNIT)


@query("gauss_subtract_int", with_(VOX, TOP, *_blur_sql("g", 3)) + "select z, y, x, greatest(a.v - g.v, 0)::bigint as v from vox a join g using (z, y, x)")
def gauss_subtract_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.gaussian_subtract(fx.volume(spark, sf_dir), 3, unit=UNIT)


LOW = 900
SET = f"p0 as (select z, y, x from vox where v >= {LOW})"
STEPS = "cross7 as (select * from (values (0,0,0),(-1,0,0),(1,0,0),(0,-1,0),(0,1,0),(0,0,-1),(0,0,1)) t(dz,dy,dx))"


def _dilate_sql(name: str, source: str, ny: int = 8, nx: int = 8) -> str:
    return f"{name} as (select distinct p.z + dz as z, p.y + dy as y, p.x + dx as x from {source} p, cross7 where p.z + dz >= 0 and p.z + dz < (select n from top) and p.y + dy between 0 and {ny - 1} and p.x + dx between 0 and {nx - 1})"


def _erode_sql(name: str, source: str) -> str:
    return f"{name} as (select p.z, p.y, p.x from {source} p, cross7 join {source} q on q.z = p.z + dz and q.y = p.y + dy and q.x = p.x + dx group by all having count(*) = 7)"


@query(
    "binary_close_open",
    with_(VOX, TOP, SET, STEPS, _dilate_sql("p1", "p0"), _erode_sql("p2", "p1"), _erode_sql("p3", "p2"), _dilate_sql("p4", "p3")) + "select z::int as z, y::int as y, x::int as x from p4",
)
def binary_close_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    sizes = V.shape(volume)
    return T.binary_open(T.binary_close(volume.where(F.col("v") >= LOW).select("z", "y", "x"), sizes, 1), sizes, 1)


# ---- components ---------------------------------------------------------------------

HIGH = 1150
#: Reachability by recursion that keeps each pair once.
REACH = (
    f"p as (select z, y, x, v, (z * 8 + y) * 8 + x as i from vox where v >= {HIGH})",
    "e as (select a.i as a, b.i as b from p a join p b on abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1 and b.z between a.z - 1 and a.z + 1)",
    "reach(a, b) as (select i, i from p union select r.a, e.b from reach r join e on r.b = e.a)",
    "comp as (select a as i, min(b) as c from reach group by a)",
)


def _high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.volume(spark, sf_dir).where(F.col("v") >= HIGH)


@query("connected_components", with_(VOX, *REACH, recursive=True) + "select p.z, p.y, p.x, (c // 64)::int as cz, (c // 8 % 8)::int as cy, (c % 8)::int as cx from p join comp using (i)")
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = G.connected_components(_high(spark, sf_dir))
    return found.select("z", "y", "x", F.col("component.z").alias("cz"), F.col("component.y").alias("cy"), F.col("component.x").alias("cx"))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.number_labels(G.connected_components(_high(spark, sf_dir)))


@query("number_labels", with_(VOX, *REACH, recursive=True) + "select p.z, p.y, p.x, dense_rank() over (order by c) as label from p join comp using (i)")
def number_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labels(spark, sf_dir)


@query("label_volumes", with_(VOX, *REACH, recursive=True) + "select p.z, p.y, p.x, count(*) over (partition by c) as volume from p join comp using (i)")
def label_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.label_volumes(_labels(spark, sf_dir))


@query("first_voxel_per_label", with_(VOX, *REACH, recursive=True) + "select dense_rank() over (order by c) as label, (c // 64)::int as z, (c // 8 % 8)::int as y, (c % 8)::int as x, volume, sum_intensity from (select c, count(*) as volume, sum(v)::bigint as sum_intensity from p join comp using (i) group by c)")
def first_voxel_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.first_voxels(_labels(spark, sf_dir).join(fx.volume(spark, sf_dir).hint("merge"), ["z", "y", "x"]))


# ---- blocks -------------------------------------------------------------------------

CHUNK = (32, 4, 4)


@query("halo_overlap_trim", with_(VOX) + "select z, y, x, v from vox")
def halo_overlap_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    sizes = V.shape(volume)
    return B.to_voxels(B.trim_halo(B.add_halo(B.from_voxels(volume, sizes, CHUNK), sizes, CHUNK, 5)))


@query("max_filter_blocks", with_(VOX, TOP, *_window_sql("m", "vox", 4, "max")) + "select z, y, x, v from mx")
def max_filter_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as over lines of voxels, but a block and its halo at a time."""
    volume = fx.volume(spark, sf_dir)
    sizes = V.shape(volume)
    halo = B.add_halo(B.from_voxels(volume, sizes, CHUNK), sizes, CHUNK, 3)
    return B.to_voxels(B.map_blocks(halo, lambda block: N.max_filter(block, 4)))


@query("watershed_cells")
def watershed_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells by watershed, in one pass over blocks; SQL has no flooding in order."""
    volume = fx.volume(spark, sf_dir)
    sizes, depth = V.shape(volume), 4

    def cells(block):
        core = block[tuple(slice(depth, n - depth) for n in block.shape)]  # the raw block is the middle of it
        mask = block >= 1000
        return N.cells(core, block, N.local_maxima(block, 4, mask), mask, depth)

    return B.halo_to_table(B.from_voxels(volume, sizes, CHUNK), sizes, CHUNK, depth, cells, "label bigint, z bigint, y bigint, x bigint, count bigint, volume bigint, sum_intensity double")


@query("points_text_roundtrip", with_(CELLS) + "select z::double as z, y::double as y, x::double as x, count(*) as n from cells group by all")
def points_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as lines of a tool's output, and parsed again."""
    from voxatlas.sources.points import parse_output_points, point_lines

    lines = point_lines(fx.cells(spark, sf_dir).select(F.lit(0).alias("cell_id"), *C.AXES))
    given = lines.select(F.concat(F.lit("Point\t7\t; InputIndex = [ 0 0 0 ]\t; OutputPoint = [ "), "line", F.lit(" ]\t; Deformation = [ 0 0 0 ]")).alias("value"))
    return parse_output_points(given).groupBy("z", "y", "x").agg(F.count("*").alias("n"))


def _mirrored_sql(axis: str, chunk: int, depth: int) -> str:
    """Each place of each block along an axis, halo included: its block, its place there and the voxel that it shows."""
    n = "(select n from top)" if axis == "z" else "8"
    return f"block_{axis} as (select c.i as chunk_{axis}, p.i as p{axis}, {_reflect(f'(c.i * {chunk} - {depth} + p.i)', n)} as {axis} from (select unnest(range(({n} + {chunk} - 1) // {chunk})) as i) c, range({chunk} + 2 * {depth}) p(i) where p.i < least({n} - c.i * {chunk}, {chunk}) + 2 * {depth})"


HALO, BLOCK = 3, (40, 4, 8)


@query(
    "halo_blocks",
    with_(VOX, TOP, *(_mirrored_sql(a, c, HALO) for a, c in zip("zyx", BLOCK, strict=True)))
    + """select chunk_z::int as chunk_z, chunk_y::int as chunk_y, chunk_x::int as chunk_x, count(*) as n, sum(v)::bigint as total, sum(v * ((pz * 7 + py * 5 + px * 3) % 97))::bigint as placed
    from block_z a, block_y b, block_x c, vox where vox.z = a.z and vox.y = b.y and vox.x = c.x group by all""",
)
def halo_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block with its halo, as sums that depend on each voxel's place in the block."""
    import numpy as np

    volume = fx.volume(spark, sf_dir)
    sizes = V.shape(volume)

    def sums(block):
        z, y, x = np.indices(block.shape)
        v = block.astype(np.int64)
        return {"z": [0], "y": [0], "x": [0], "n": [v.size], "total": [v.sum()], "placed": [(v * ((z * 7 + y * 5 + x * 3) % 97)).sum()]}

    table = B.halo_to_table(B.from_voxels(volume, sizes, BLOCK), sizes, BLOCK, HALO, sums, "z bigint, y bigint, x bigint, n bigint, total bigint, placed bigint")
    return table.drop("z", "y", "x")


@query("maxima_coords", with_(VOX, TOP, *_window_sql("m", "vox", 4, "max")) + "select 1::bigint as label, a.z, a.y, a.x, -1 as volume, -1 as sum_intensity from vox a join mx b using (z, y, x) where a.v = b.v and a.v >= 1000")
def maxima_coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of the maxima alone, found block by block."""
    volume = fx.volume(spark, sf_dir)
    sizes = V.shape(volume)
    halo = B.add_halo(B.from_voxels(volume, sizes, BLOCK), sizes, BLOCK, HALO)
    return V.nonzero(B.to_voxels(B.map_blocks(halo, lambda block: N.local_maxima(block, 4, block >= 1000).astype("u1")), zeros=False))


@query("block_places", with_(VOX) + f"select (z // {BLOCK[0]})::int as chunk_z, (y // {BLOCK[1]})::int as chunk_y, (x // {BLOCK[2]})::int as chunk_x, z % {BLOCK[0]} as z, y % {BLOCK[1]} as y, x % {BLOCK[2]} as x, v from vox where v > 1100")
def block_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of the whole volume as places within blocks."""
    volume = fx.volume(spark, sf_dir)
    blocks = B.from_voxels(volume, V.shape(volume), BLOCK)
    keyed = volume.where("v > 1100").select(*(F.expr(f"cast({a} div {c} as int)").alias(k) for a, c, k in zip(B.AXES, BLOCK, B.KEY, strict=True)), *B.AXES, "v")
    return B.to_block(keyed, blocks)


@query(
    "cells_of_labels",
    with_(VOX, "seeds as (select z, y, x, z // 10 + 1 as label, (z * 8 + y) * 8 + x as i from vox where v >= 1100)", "grown as (select v, z // 10 + 1 as label from vox where v >= 1000 and y < 4 and z % 20 < 17)")
    + "select s.label, (i // 64)::int as z, (i // 8 % 8)::int as y, (i % 8)::int as x, 1::bigint as count, volume, sum_intensity from (select label, min(i) as i from seeds group by label) s join (select label, count(*) as volume, sum(v)::bigint as sum_intensity from grown group by label) g using (label)",
)
def cells_of_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir).withColumn("label", F.expr("z div 10 + 1"))
    return G.cells_of_labels(volume, volume.where("v >= 1100"), volume.where("v >= 1000 and y < 4 and z % 20 < 17"))


@query(
    "specimen_histograms",
    with_(VOX, "named as (select case when z % 3 = 0 then 'a' else 'b' end as specimen, v from vox)", "b as (select specimen, least(floor(v::double / (5000.0::double / 256)), 255)::int as bin, count(*) as n from named where v between 0 and 5000 group by all)", "t as (select specimen, sum(n) as n from b group by all)")
    + "select t.specimen, round(r.i * (5000.0::double / 256), 9) as left_edge, round(coalesce(b.n, 0) / (t.n * (5000.0::double / 256)), 12) as density from t cross join range(256) r(i) left join b on b.bin = r.i and b.specimen = t.specimen",
)
def specimen_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fx.volume(spark, sf_dir)
    out = V.specimen_histograms({"a": volume.where("z % 3 = 0"), "b": volume.where("z % 3 <> 0")})
    return out.select("specimen", F.round("left", 9).alias("left_edge"), F.round("density", 12).alias("density"))


#: The voxels as sixteen by sixty-four in y and x, in which two steps of erosion leave something.
WIDE, BRIGHT = "wide as (select (z // 16)::int as z, (z % 16)::int as y, (y * 8 + x)::int as x, v from vox)", 1070


@query(
    "binary_close_open_twice",
    with_(VOX, WIDE, "top as (select max(z) + 1 as n from wide)", f"p0 as (select z, y, x from wide where v >= {BRIGHT})", STEPS, *(_dilate_sql(f"p{k + 1}", f"p{k}", 16, 64) for k in (0, 1)), *(_erode_sql(f"p{k + 1}", f"p{k}") for k in (2, 3, 4, 5)), *(_dilate_sql(f"p{k + 1}", f"p{k}", 16, 64) for k in (6, 7)))
    + "select z::int as z, y::int as y, x::int as x from p8",
)
def binary_close_open_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = fx.volume(spark, sf_dir).select(F.expr("cast(z div 16 as int)").alias("z"), F.expr("cast(z % 16 as int)").alias("y"), F.expr("cast(y * 8 + x as int)").alias("x"), "v")
    sizes = V.shape(wide)
    return T.binary_open(T.binary_close(wide.where(F.col("v") >= BRIGHT).select("z", "y", "x"), sizes), sizes)


# ---- transformations ----------------------------------------------------------------

ORIGIN, SPACING, CONTROL = (-4, -8, -16), (4, 8, 16), (6, 5, 6)
_DISPLACED = {"z": "((gz * 7 + gy * 3 + gx) % 11 - 5) / 8.0", "y": "((gz * 2 + gy * 5 + gx * 3) % 7 - 3) / 4.0", "x": "((gz + gy + gx) % 5 - 2) / 2.0"}


def _cubic_sql(k: str, u: str) -> str:
    v = f"(1.0::double - {u})"
    return f"(case {k} when 0 then {v} * {v} * {v} / 6 when 1 then (3 * {u} * {u} * {u} - 6 * {u} * {u} + 4) / 6 when 2 then (3 * {v} * {v} * {v} - 6 * {v} * {v} + 4) / 6 else {u} * {u} * {u} / 6 end)"


_SPOTS = "spots as (select distinct z::double as z, y::double as y, x::double as x from cells)"


@query(
    "bspline_points",
    with_(
        CELLS,
        _SPOTS,
        "grid as (select a.i as gz, b.i as gy, c.i as gx from range({}) a(i), range({}) b(i), range({}) c(i))".format(*CONTROL),
        "field as (select gz, gy, gx, " + ", ".join(f"({e})::double as d{a}" for a, e in _DISPLACED.items()) + " from grid)",
        "four as (select unnest(range(4)) as k)",
        "laid as (select z, y, x, " + ", ".join(f"floor(({a} - {o}) / {s})::int - 1 + f{a}.k as g{a}, {_cubic_sql(f'f{a}.k', f'(({a} - {o}) / {s} - floor(({a} - {o}) / {s}))')} as w{a}" for a, o, s in zip("zyx", ORIGIN, map(float, SPACING), strict=True)) + " from spots, four fz, four fy, four fx)",
        "sums as (select z, y, x, " + ", ".join(f"sum(wz * wy * wx * d{a}) as d{a}" for a in "zyx") + " from laid join field using (gz, gy, gx) group by z, y, x having count(*) = 64)",
    )
    + "select z, y, x, " + ", ".join(f"round({a} + coalesce(d{a}, 0), 6) + 0.0 as {a}_new" for a in "zyx") + " from spots left join sums using (z, y, x)",
)
def bspline_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell places moved by a field of cubic B-splines; some lie outside of it."""
    z, y, x = CONTROL
    grid = spark.range(z * y * x).select(F.expr(f"cast(id div {y * x} as int)").alias("gz"), F.expr(f"cast(id div {x} % {y} as int)").alias("gy"), F.expr(f"cast(id % {x} as int)").alias("gx"))
    field = grid.select("gz", "gy", "gx", *(F.expr(f"cast({e} as double)").alias(f"d{a}") for a, e in _DISPLACED.items()))
    spots = fx.cells(spark, sf_dir).select(*(F.col(a).cast("double").alias(a) for a in C.AXES)).distinct()
    keyed = spots.select(F.expr("cast(z * 10000 + y * 100 + x as bigint)").alias("cell_id"), *C.AXES)
    moved = C.attach_transformed(keyed, P.bspline(keyed, field, ORIGIN, SPACING))
    return moved.select(*C.AXES, *((F.round(f"{a}_trfm", 6) + F.lit(0.0)).alias(f"{a}_new") for a in C.AXES))


WARPED = (20, 6, 7)


@query(
    "warp_image",
    with_(
        VOX,
        "grid as (select a.i::int as z, b.i::int as y, c.i::int as x from range({}) a(i), range({}) b(i), range({}) c(i))".format(*WARPED),
        "moved as (select z, y, x, z * 2.5::double + 0.25 as pz, y * 1.25::double - 1 as py, x * 1.0::double + y * 0.5::double as px from grid)",
        "two as (select unnest(range(2)) as k)",
        "laid as (select z, y, x, " + ", ".join(f"floor(p{a})::int + t{a}.k as q{a}, case t{a}.k when 1 then p{a} - floor(p{a}) else 1 - (p{a} - floor(p{a})) end as w{a}" for a in "zyx") + " from moved, two tz, two ty, two tx)",
        "read as (select l.z, l.y, l.x, sum(wz * wy * wx * o.v) as v from laid l join vox o on o.z = qz and o.y = qy and o.x = qx group by all)",
    )
    + "select z, y, x, round(coalesce(v, 0), 6) as v from grid left join read using (z, y, x)",
)
def warp_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume seen from another space, by an affine transformation."""
    moved = P.warp_image(fx.volume(spark, sf_dir), WARPED, lambda points: C.affine(points, [[2.5, 0, 0], [0, 1.25, 0], [0, 0.5, 1]], [0.25, -1, 0]))
    return moved.withColumn("v", F.round("v", 6))


#: A turn, a shear and a shift of cell places; the field above follows.
TURN, SHIFT, CENTRE = [[1.0, 0.02, -0.01], [0.03, 0.95, 0.02], [-0.02, 0.04, 1.05]], [0.4, -0.3, 0.8], [4.0, 8.0, 16.0]


def _affine_sql(matrix, offset, centre) -> list[str]:
    """Expressions of the moved z, y and x."""
    return [" + ".join(f"({m!r}::double) * ({a} - {c!r}::double)" for m, a, c in zip(row, "zyx", centre, strict=True)) + f" + {centre[k] + offset[k]!r}::double" for k, row in enumerate(matrix)]


@query(
    "transform_chain",
    with_(
        CELLS,
        _SPOTS,
        "turned as (select z as z0, y as y0, x as x0, " + ", ".join(f"{e} as {a}" for a, e in zip("zyx", _affine_sql(TURN, SHIFT, CENTRE), strict=True)) + " from spots)",
        "grid as (select a.i as gz, b.i as gy, c.i as gx from range({}) a(i), range({}) b(i), range({}) c(i))".format(*CONTROL),
        "field as (select gz, gy, gx, " + ", ".join(f"({e})::double as d{a}" for a, e in _DISPLACED.items()) + " from grid)",
        "four as (select unnest(range(4)) as k)",
        "laid as (select z0, y0, x0, z, y, x, " + ", ".join(f"floor(({a} - {o}) / {s})::int - 1 + f{a}.k as g{a}, {_cubic_sql(f'f{a}.k', f'(({a} - {o}) / {s} - floor(({a} - {o}) / {s}))')} as w{a}" for a, o, s in zip("zyx", ORIGIN, map(float, SPACING), strict=True)) + " from turned, four fz, four fy, four fx)",
        "sums as (select z0, y0, x0, " + ", ".join(f"sum(wz * wy * wx * d{a}) as d{a}" for a in "zyx") + " from laid join field using (gz, gy, gx) group by z0, y0, x0 having count(*) = 64)",
    )
    + "select z0 as z, y0 as y, x0 as x, " + ", ".join(f"round({a} + coalesce(d{a}, 0), 6) + 0.0 as {a}_new" for a in "zyx") + " from turned left join sums using (z0, y0, x0)",
)
def transform_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell places moved by an affine transformation and then a field, both read from parameter files."""
    z, y, x = np.meshgrid(*map(np.arange, CONTROL), indexing="ij")
    grid = np.stack([((z * 7 + y * 3 + x) % 11 - 5) / 8, ((z * 2 + y * 5 + x * 3) % 7 - 3) / 4, ((z + y + x) % 5 - 2) / 2], axis=-1)
    field = BSplineField(grid, np.array(ORIGIN, float), np.array(SPACING, float))
    folder = shared_path(spark)
    write_chain(spark, Chain((Affine(np.array(TURN), np.array(SHIFT), np.array(CENTRE)), field)), folder)
    spots = fx.cells(spark, sf_dir).select(*(F.col(a).cast("double").alias(a) for a in C.AXES)).distinct()
    moved = move_points(spots.select(*C.AXES, *(F.col(a).alias(f"{a}_old") for a in C.AXES)), read_chain(spark, folder))
    return moved.select(*(F.col(f"{a}_old").alias(a) for a in C.AXES), *((F.round(a, 6) + F.lit(0.0)).alias(f"{a}_new") for a in C.AXES))


def _coefficients_sql(prefix: str, source: str, sizes: dict[str, str]) -> list[str]:
    """Coefficients of the spline through a volume (z, y, x, v), one axis after the other, as <prefix>x."""
    out = []
    for axis, n in sizes.items():
        a, b = (c for c in "zyx" if c != axis)
        mirror = "(case when {0} % (2 * (n - 1)) > n - 1 then 2 * (n - 1) - {0} % (2 * (n - 1)) else {0} % (2 * (n - 1)) end)"
        taps = f"select k, {mirror.format('(k + d + 200 * (n - 1))')} as i, sum(sqrt(3) * pow(sqrt(3) - 2, abs(d))) as w from (select n, unnest(range(n)) as k from (select {n} as n)), range(-45, 46) s(d) group by all"
        out.append(f"{prefix}{axis} as (select w.k as {axis}, p.{a}, p.{b}, sum(p.v * w.w) as v from ({taps}) w join {source} p on p.{axis} = w.i group by all)")
        source = f"{prefix}{axis}"
    return out


def _read_sql(source: str, places: str, keys: str, sizes: dict[str, str], slack: float = 0.0) -> str:
    """Values of a spline at places (pz, py, px) within its volume, by ``keys``."""
    within = " and ".join(f"p{a} >= -{slack} and p{a} <= {n} - 1 + {slack}" for a, n in sizes.items())
    near = ", ".join(f"(case when floor(p{a})::int - 1 + f{a}.k < 0 then 1 - floor(p{a})::int - f{a}.k when floor(p{a})::int - 1 + f{a}.k > {n} - 1 then 2 * ({n} - 1) - floor(p{a})::int + 1 - f{a}.k else floor(p{a})::int - 1 + f{a}.k end) as q{a}, {_cubic_sql(f'f{a}.k', f'(p{a} - floor(p{a}))')} as w{a}" for a, n in sizes.items())
    own = ", ".join(f"l.{k}" for k in keys.split(", "))
    return f"select {own}, sum(wz * wy * wx * c.v) as v from (select {keys}, {near} from {places}, four fz, four fy, four fx where {within}) l join {source} c on c.z = qz and c.y = qy and c.x = qx group by {own}"


_VOX_SIZES = {"z": "(select max(z) + 1 from vox)", "y": "8", "x": "8"}


@query(
    "warp_image_cubic",
    with_(
        VOX,
        "flat as (select z, y, x, v::double as v from vox)",
        *_coefficients_sql("c", "flat", {k: v if k == "z" else v + "::bigint" for k, v in _VOX_SIZES.items()}),
        "grid as (select a.i::int as z, b.i::int as y, c.i::int as x from range({}) a(i), range({}) b(i), range({}) c(i))".format(*WARPED),
        "moved as (select z, y, x, z * 2.5::double + 0.25 as pz, y * 1.25::double - 1 as py, x * 1.0::double + y * 0.5::double as px from grid)",
        "four as (select unnest(range(4)) as k)",
        "seen as (" + _read_sql("cx", "moved", "z, y, x", _VOX_SIZES) + ")",
    )
    + "select z, y, x, round(coalesce(v, 0), 5) + 0.0 as v from grid left join seen using (z, y, x)",
)
def warp_image_cubic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volume seen from another space through the cubic spline of its voxels, chunk by chunk."""
    voxels = fx.volume(spark, sf_dir)
    sizes, chunk = V.shape(voxels), (64, 8, 8)
    move = Affine(np.array([[2.5, 0, 0], [0, 1.25, 0], [0, 0.5, 1]]), np.array([0.25, -1, 0]), np.zeros(3))
    seen = S.warp_image(kept(B.from_voxels(voxels, sizes, chunk)), sizes, chunk, WARPED, (8, 6, 7), move)
    return B.to_values(seen).withColumn("v", F.round("v", 5) + F.lit(0.0))


# ---- registration -------------------------------------------------------------------

#: Affine transformations to measure: matrix, offset, and what they turn about.
MEASURED = {"still": ([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], [0.0, 0.0, 0.0]), "shifted": ([[1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0]], [0.5, -0.25, 0.4]), "turned": (TURN, SHIFT)}
MIDDLE, BINS, SAMPLED = [9.5, 19.5, 19.5], 12, 5000
BODY = "body as (select (i // 1600)::int as z, (i // 40 % 40)::int as y, (i % 40)::int as x, v::double as v from (select z * 64 + y * 8 + x as i, v from vox))"
_BODY_SIZES = {"z": "(select max(z) + 1 from body)", "y": "40", "x": "40"}


def _bins_sql(value: str, low: str, high: str, k: str) -> str:
    t = f"(1 + (least(greatest({value}, {low}), {high}) - {low}) * ({BINS - 3} / ({high} - {low})))"
    first = f"least(floor({t}), {BINS - 3})"
    return f"({first}::int - 1 + {k}) as b{value}, {_cubic_sql(k, f'({t} - {first})')} as w{value}"


def _image(voxels: DataFrame, sizes: B.Shape, chunk: B.Shape) -> J.Image:
    """Voxels as an image; the last plane of a body may be cut short."""
    mask = B.presence(voxels, sizes, chunk)
    return J.Image(kept(B.from_voxels(voxels, sizes, chunk)), sizes, chunk, None if mask is None else kept(mask))


@query(
    "mutual_information",
    with_(
        VOX,
        BODY,
        *_coefficients_sql("c", "body", {k: v if k == "z" else v + "::bigint" for k, v in _BODY_SIZES.items()}),
        f"samples as (select z, y, x, v as f from body where ((z::bigint * 40 + y) * 40 + x) * 2654435761 % 4294967296 < 4294967296 * {SAMPLED} // (select count(*) from body))",
        "moved as (" + " union all ".join(f"select '{name}' as name, z, y, x, " + ", ".join(f"{e} as p{a}" for a, e in zip("zyx", _affine_sql(matrix, offset, MIDDLE), strict=True)) + " from samples" for name, (matrix, offset) in MEASURED.items()) + ")",
        "four as (select unnest(range(4)) as k)",
        "seen as (" + _read_sql("cx", "moved", "name, z, y, x", _BODY_SIZES, J.SLACK) + ")",
        "pairs as (select name, f, seen.v as m from seen join samples using (z, y, x))",
        "ends as (select (select min(f) from samples) as f0, (select max(f) from samples) as f1, (select min(v) from body) as m0, (select max(v) from body) as m1)",
        "terms as (select name, " + _bins_sql("f", "f0", "f1", "a.k") + ", " + _bins_sql("m", "m0", "m1", "b.k") + " from pairs, ends, four a, four b)",
        "joint as (select name, bf, bm, sum(wf * wm) as h from terms group by all)",
        "shares as (select name, bf, bm, h / sum(h) over (partition by name) as p from joint)",
        "sides as (select name, p, sum(p) over (partition by name, bf) as pf, sum(p) over (partition by name, bm) as pm from shares)",
    )
    + "select name, round(sum(case when p > 0 then p * ln(p / (pf * pm)) else 0 end), 8) as information from sides group by name",
)
def mutual_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sampled voxels tell of the same volume at their moved places, for three transformations."""
    voxels = fx.body(spark, sf_dir)
    sizes, chunk = V.shape(voxels), (16, 20, 20)
    image = _image(voxels, sizes, chunk)
    measure = J.Measure(image, (1, 1, 1), J.sample(image, (1, 1, 1), SAMPLED), BINS)
    found = [(name, round(J.information(measure.joint(Affine(np.array(matrix), np.array(offset), np.array(MIDDLE))))[0], 8)) for name, (matrix, offset) in MEASURED.items()]
    measure.close()
    return spark.createDataFrame(found, "name string, information double")


def _smooth_body(spark: SparkSession, sf_dir: str) -> J.Image:
    voxels = fx.body(spark, sf_dir)
    sizes, chunk = V.shape(voxels), (16, 24, 24)
    image = _image(voxels, sizes, chunk)
    return replace(image, chunks=kept(J.smooth(image.chunks, sizes, chunk, 2.0, image.mask)))


def _inverted(image: J.Image, sizes: B.Shape, move) -> J.Image:
    """The image seen through a transformation, dark where it is bright, where its voxels are seen."""
    seen = S.warp_image(image.chunks, image.sizes, image.chunk, sizes, image.chunk, move)
    there = B.map_blocks(image.chunks, lambda v: np.ones(v.shape, "u1")) if image.mask is None else image.mask
    held = B.map_blocks(S.warp(there, image.sizes, image.chunk, sizes, image.chunk, move, order=1), lambda v: (v > 1 - 1e-6).astype("u1"))
    return J.Image(kept(B.map_blocks(seen, lambda v: (4000 - 2 * v).astype("<f4"))), sizes, image.chunk, kept(held))


#: The fixed image lies this deep within the moving one, turned and sheared.
DEEP = 3
PLANTED = [[1.01, 0.02, -0.01], [0.02, 0.98, 0.03], [-0.01, -0.03, 1.02]]
_CORNERS = "corners as (select a.i::int as z, b.i::int as y, c.i::int as x from (select unnest([0, (select max(z) - 6 from body)]) as i) a, (select unnest([0, 33]) as i) b, (select unnest([0, 33]) as i) c)"


@query("affine_registration", with_(VOX, BODY, _CORNERS) + "select z, y, x, true as found from corners")
def affine_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A planted affine transformation: whether registration finds where it takes each corner, within half a voxel."""
    moving = _smooth_body(spark, sf_dir)
    sizes = tuple(n - 2 * DEEP for n in moving.sizes)
    planted = Affine(np.array(PLANTED), np.full(3, DEEP) + np.array([0.4, -0.3, 0.5]), (np.array(sizes) - 1) / 2)
    found = J.register_affine(_inverted(moving, sizes, planted), moving, J.Settings(levels=2, turns=30, samples=8000)).move
    corners = np.array([[z, y, x] for z in (0, sizes[0] - 1) for y in (0, sizes[1] - 1) for x in (0, sizes[2] - 1)], float).T
    apart = np.linalg.norm(found(corners) - planted(corners), axis=0)
    return spark.createDataFrame([(*map(int, c), bool(d < 0.5)) for c, d in zip(corners.T, apart, strict=True)], "z int, y int, x int, found boolean")


@query("bspline_registration", with_(VOX, BODY) + "select z, y, x, true as found from (select z, y, x from body where z % 6 = 2 and y % 6 = 2 and x % 6 = 2 and z < (select max(z) - 7 from body) and y < 32 and x < 32)")
def bspline_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A planted field, of up to three voxels: whether registration finds where it takes places, within one."""
    moving = _smooth_body(spark, sf_dir)
    sizes, shift = tuple(n - 2 * DEEP for n in moving.sizes), Affine(np.eye(3), np.full(3, float(DEEP)), np.zeros(3))
    still = BSplineField.still(moving.sizes, (16.0, 16.0, 16.0))
    z, y, x = np.meshgrid(*map(np.arange, still.grid.shape[:3]), indexing="ij")
    planted = Chain((shift, BSplineField(np.stack([np.sin(z * 2 + y), np.cos(y * 2 + x), np.sin(x * 2 + z + y)], axis=-1) * 4, still.origin, still.spacing)))
    found = Chain((shift, J.register_bspline(_inverted(moving, sizes, planted), moving, shift, J.Settings(levels=2, turns=30, samples=12_000, spacing=(16.0, 16.0, 16.0))).move))
    places = np.array([[z, y, x] for z in range(2, moving.sizes[0] - 8, 6) for y in range(2, 32, 6) for x in range(2, 32, 6)], float).T
    apart = np.linalg.norm(found(places) - planted(places), axis=0)
    return spark.createDataFrame([(*map(int, p), bool(d < 1)) for p, d in zip(places.T, apart, strict=True)], "z int, y int, x int, found boolean")


# ---- names, numbers, documents ------------------------------------------------------

_NAME = "'slice_' || (s_suppkey % 1000)::varchar || '.tif' as name"


@query("natural_order", f"select name, row_number() over (order by k, id) as place from (select {_NAME}, s_suppkey % 1000 as k, s_suppkey as id from supplier where s_suppkey % 3 <> 0)")
def natural_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of slices that match a pattern, in the order of their numbers."""
    from voxatlas.sources.tables import matching_files

    names = fx.table(spark, sf_dir, "supplier").select(F.format_string("slice_%d.%s", F.col("s_suppkey") % 1000, F.when(F.col("s_suppkey") % 3 == 0, "txt").otherwise("tif")).alias("path"), "s_suppkey")
    found = matching_files(names, r"\.tif$")
    return numbered(found, ["natural_key", "s_suppkey"], "place").select(F.col("path").alias("name"), "place")


@query("zero_padded_names", "select s_suppkey, 'slice_' || lpad((s_suppkey % 1000)::varchar, 4, '0') || '.tif' as name from supplier")
def zero_padded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.table(spark, sf_dir, "supplier").select("s_suppkey", scalar.zero_padded(F.concat(F.lit("slice_"), (F.col("s_suppkey") % 1000).cast("string"), F.lit(".tif"))).alias("name"))


@query(
    "unsigned_numbers",
    "select s_suppkey, trunc(f)::bigint as truncated, (trunc(f)::bigint % 256 + 256) % 256 as wrapped, greatest(least(round_even(f, 0), 65535), 0)::int as saturated, (65536 - s_suppkey % 65536) % 65536 as negated from (select s_suppkey, s_acctbal::double * 13 as f from supplier)",
)
def unsigned_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncation, wrapping, saturation and negation, as unsigned integers do them."""
    f = F.col("s_acctbal").cast("double") * 13
    return fx.table(spark, sf_dir, "supplier").select("s_suppkey", scalar.truncate(f).alias("truncated"), scalar.truncate(f, 8).alias("wrapped"), scalar.saturate(f).alias("saturated"), scalar.negate_unsigned("s_suppkey").alias("negated"))


@query("ontology_document", with_(ONT) + "select id, name, parent as parent_structure_id from ont")
def ontology_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region table as a nested document, and flattened again."""
    regions = fx.regions(spark, sf_dir)
    missing = [F.lit(None).cast(kind).alias(c) for c, kind in O.ONTOLOGY_FIELDS.items() if c not in regions.columns]
    return O.flatten(O.nest(regions.select("*", *missing))).select("id", "name", "parent_structure_id")


@query("points_dense", with_(CELLS, POINTS, ROUNDED) + f"select g.z, g.y, g.x, coalesce(n, 0)::bigint as v from (select a.i::int as z, b.i::int as y, c.i::int as x from range(7) a(i), range(15) b(i), range(30) c(i)) g left join (select z, y, x, count(*) as n from rounded where {INSIDE} group by all) using (z, y, x)")
def points_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.dense(R.points_count(_points(spark, sf_dir), SHAPE), SHAPE)
