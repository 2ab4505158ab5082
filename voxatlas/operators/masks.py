"""Masks: outlines as runs along x, filling them again, and coverage of regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxatlas.functions.scalar import ratio
from voxatlas.operators import ontology

AXES = ("z", "y", "x")


def outline(mask: DataFrame) -> DataFrame:
    """(z, y, x, is_in, seq): run starts (is_in 1) and run ends (0) of a dense mask along x.

    ``seq`` is 0 for starts and 1 for ends: where a run is one voxel long, its start comes first.
    """
    line = Window.partitionBy("z", "y").orderBy("x")
    edges = mask.select(*AXES, "v", F.lag("v", 1, 0).over(line).alias("_l"), F.lead("v", 1, 0).over(line).alias("_r")).where("v = 1")
    events = F.array(F.when(F.col("_l") == 0, F.struct(F.lit(1).alias("is_in"), F.lit(0).alias("seq"))), F.when(F.col("_r") == 0, F.struct(F.lit(0).alias("is_in"), F.lit(1).alias("seq"))))
    return edges.select(*AXES, F.explode(F.array_compact(events)).alias("_e")).select(*AXES, "_e.is_in", "_e.seq")


def intervals(events: DataFrame, length: int) -> DataFrame:
    """(z, y, start, end): what events paint along x, ``end`` exclusive.

    A start paints from its x on and an end clears after its x, each up to what the
    next event clears; a run without an end goes to the end of the line.
    """
    later = Window.partitionBy("z", "y").orderBy("x", "seq").rowsBetween(1, Window.unboundedFollowing)
    stop = F.coalesce(F.min(F.col("x") + 1 - F.col("is_in")).over(later), F.lit(length))
    spans = events.select("z", "y", "is_in", (F.col("x") + 1 - F.col("is_in")).alias("start"), stop.alias("end"))
    return spans.where("is_in = 1 and start < end").drop("is_in")


def fill(events: DataFrame, length: int) -> DataFrame:
    """The set voxels (z, y, x) of an outline."""
    return intervals(events, length).select("z", "y", F.explode(F.sequence(F.col("start"), F.col("end") - 1)).alias("x"))


def outline_code(events: DataFrame) -> DataFrame:
    """(z, y, x, v) with v = 1 at starts, 2 at ends, 3 at both."""
    return events.groupBy(*AXES).agg((F.max("is_in") + 2 * F.max(1 - F.col("is_in"))).alias("v"))


def region_counts(points: DataFrame, annotation: DataFrame) -> DataFrame:
    """(id, volume): set voxels by region, without the voxels outside of all regions."""
    return points.select(*AXES).join(annotation.select(*AXES, "id"), list(AXES)).where("id <> 0").groupBy("id").agg(F.count("*").alias("volume"))


def coverage(mask_points: DataFrame, annotation: DataFrame, whole_annotation: DataFrame, regions: DataFrame) -> DataFrame:
    """Share of each region that the mask covers, over the region tree.

    ``whole_annotation`` is the atlas as it came, which gives the regions' volumes;
    ``annotation`` is the one in the mask's space.
    """
    whole = whole_annotation.where("id <> 0").groupBy("id").agg(F.count("*").alias("volume_annot"))
    mask = region_counts(mask_points, annotation).withColumnRenamed("volume", "volume_mask")
    both = whole.join(mask, "id", "left").withColumn("volume_mask", F.coalesce("volume_mask", F.lit(0)))
    return ontology.rollup(both, regions, ["volume_annot", "volume_mask"]).withColumn("volume_prop", ratio("volume_mask", "volume_annot"))
