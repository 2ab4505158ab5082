"""Stand-ins for images and cells, derived from the tables that queries run over.

A dense volume comes from the embeddings, an ontology from regions, nations and
suppliers, cells from line items, an annotation volume from a rule over coordinates,
and specimens from the return flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense voxels (z, y, x, v), 8 by 8 in y and x."""
    places = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("z"), F.posexplode("embedding").alias("i", "e"))
    return places.select("z", F.expr("i div 8").cast("int").alias("y"), F.expr("i % 8").cast("int").alias("x"), F.floor((F.col("e").cast("double") + 1) * 1000).cast("bigint").alias("v"))


#: Voxels of a plane of ``body``.
PLANE = (40, 40)


def body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same voxels as ``volume``, in their order, laid out 40 by 40 in y and x."""
    ny, nx = PLANE
    numbered = volume(spark, sf_dir).select(F.expr("z * 64L + y * 8 + x").alias("i"), "v")
    return numbered.select(F.expr(f"cast(i div {ny * nx} as int)").alias("z"), F.expr(f"cast(i div {nx} % {ny} as int)").alias("y"), F.expr(f"cast(i % {nx} as int)").alias("x"), "v")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of world, regions, nations and suppliers, with the columns of an ontology."""
    world = spark.range(1).select(F.lit(1).cast("bigint").alias("id"), F.lit("world").alias("name"), F.lit(None).cast("bigint").alias("parent_structure_id"))
    region = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 10).cast("bigint").alias("id"), F.col("r_name").alias("name"), F.lit(1).cast("bigint").alias("parent_structure_id"))
    nation = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 100).cast("bigint").alias("id"), F.col("n_name").alias("name"), (F.col("n_regionkey") + 10).cast("bigint").alias("parent_structure_id"))
    supplier = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 100000).cast("bigint").alias("id"), F.col("s_name").alias("name"), (F.col("s_nationkey") + 100).cast("bigint").alias("parent_structure_id"))
    tree = world.unionByName(region).unionByName(nation).unionByName(supplier)
    return tree.select("id", F.col("name").alias("acronym"), "name", F.lpad(F.hex("id"), 6, "0").alias("color_hex_triplet"), "parent_structure_id", F.col("id").alias("preorder"))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cell for each line item: specimen, measures, coordinates and a region id of every kind."""
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    region = (
        F.when(F.col("l_linenumber") == 7, 0)
        .when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "R"), -1)
        .when((F.col("l_linenumber") == 5) & (F.col("l_returnflag") == "A"), 999)
        .when(F.col("l_linestatus") == "O", 100 + F.col("s_nationkey"))
        .otherwise(100000 + F.col("l_suppkey"))
    )
    return line.select(
        F.col("l_returnflag").alias("specimen"),
        F.lit(1).cast("bigint").alias("count"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("sum_intensity"),
        F.col("l_linenumber").cast("int").alias("z"),
        (F.col("l_suppkey") % 16).cast("int").alias("y"),
        (F.col("l_partkey") % 32).cast("int").alias("x"),
        region.cast("bigint").alias("id"),
    )


def annotation(spark: SparkSession) -> DataFrame:
    """A grid of 8 by 16 by 32 voxels: 0 outside, nations inside."""
    grid = spark.range(8 * 16 * 32).select(F.expr("cast(id div 512 as int)").alias("z"), F.expr("cast(id div 32 % 16 as int)").alias("y"), F.expr("cast(id % 32 as int)").alias("x"))
    return grid.withColumn("id", F.expr("cast(case when (x + y) % 5 = 0 then 0 else 100 + (z * 7 + y * 3 + x) % 25 end as bigint)"))
