"""Connected components of set voxels, and measures by label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxatlas.operators.kept import kept
from voxatlas.operators.numbering import numbered

AXES = ("z", "y", "x")


def runs(points: DataFrame) -> DataFrame:
    """Set voxels with the first x of their run along x: (z, y, x, start)."""
    from pyspark.sql import Window

    line = Window.partitionBy("z", "y").orderBy("x")
    return points.select(*AXES).withColumn("_k", F.col("x") - F.row_number().over(line)).withColumn("start", F.min("x").over(Window.partitionBy("z", "y", "_k"))).drop("_k")


def connected_components(points: DataFrame) -> DataFrame:
    """(z, y, x, component): six-connected components, named by their first voxel (z, y, x).

    Voxels are first contracted to runs along x, which are the nodes; runs that touch
    in y or z are linked.  Then each turn takes the least name of the neighbours and the
    name of that name, which halves long chains, until no name changes.  Joins shuffle
    both sides: tables small enough to broadcast would go through the driver in every turn.
    """
    name = F.struct("z", "y", F.col("start").alias("x"))
    voxels = kept(runs(points).select(*AXES, name.alias("run")))
    here = voxels.select(*AXES, F.col("run").alias("a"))
    links = None
    for axis in ("z", "y"):
        there = voxels.select(*((F.col(c) + 1).alias(c) if c == axis else F.col(c) for c in AXES), F.col("run").alias("b"))
        touching = here.join(there.hint("merge"), list(AXES)).select("a", "b")
        links = touching if links is None else links.unionAll(touching)
    both = kept(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = voxels.select("run").distinct().select("run", F.col("run").alias("component"))
    while True:
        near = both.join(labels.select(F.col("run").alias("b"), F.col("component").alias("m")).hint("merge"), "b").groupBy("a").agg(F.min("m").alias("m"))
        least = kept(labels.join(near.hint("merge"), labels["run"] == near["a"], "left").select("run", F.col("component").alias("was"), F.least("component", F.coalesce("m", "component")).alias("component")))
        jump = least.select(F.col("run").alias("_at"), F.col("component").alias("_further"))
        labels = kept(least.join(jump.hint("merge"), F.col("component") == F.col("_at"), "left").select("run", "was", F.least("component", F.coalesce("_further", "component")).alias("component")))
        if labels.where("was <> component").isEmpty():
            break
        labels = labels.drop("was")
    return voxels.join(labels.drop("was").hint("merge"), "run").select(*AXES, "component")


def number_labels(components: DataFrame) -> DataFrame:
    """Components numbered from 1 in the order of their first voxels: (z, y, x, label)."""
    numbers = numbered(components.select("component").distinct(), ["component"], "label")
    return components.join(numbers.hint("merge"), "component").select(*AXES, "label")


def label_volumes(labelled: DataFrame, label: str = "label", bits: int | None = None) -> DataFrame:
    """Each voxel with the voxel count of its label; with ``bits`` wrapped to that width."""
    counts = labelled.groupBy(label).agg(F.count("*").alias("volume"))
    if bits:
        counts = counts.withColumn("volume", F.pmod("volume", F.lit(1 << bits)))
    return labelled.join(counts.hint("merge"), label).select(*AXES, "volume")


def first_voxels(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Each label's first voxel, its voxel count, and the sum of v where there is one."""
    measures = [F.min(F.struct(*AXES)).alias("_f"), F.count("*").alias("volume")]
    if "v" in labelled.columns:
        measures.append(F.sum("v").alias("sum_intensity"))
    out = labelled.groupBy(label).agg(*measures)
    return out.select(label, *(F.col(f"_f.{a}").alias(a) for a in AXES), *out.columns[2:])


def cells_of_labels(raw: DataFrame, seeds: DataFrame, grown: DataFrame) -> DataFrame:
    """Cells from two label volumes: where each seed label begins, and what its grown label measures.

    ``seeds`` and ``grown`` have (z, y, x, label), ``raw`` the intensities; a label
    that nothing has grown from gives no cell.
    """
    at = seeds.where("label > 0").groupBy("label").agg(F.min(F.struct(*AXES)).alias("_f"))
    measured = grown.where("label > 0").select(*AXES, "label").join(raw.select(*AXES, "v"), list(AXES)).groupBy("label").agg(F.count("*").alias("volume"), F.sum("v").alias("sum_intensity"))
    return at.join(measured, "label").select("label", *(F.col(f"_f.{a}").alias(a) for a in AXES), F.lit(1).cast("bigint").alias("count"), "volume", "sum_intensity")
