"""The region ontology: a forest of regions as a parent-pointer table.

An ontology is small (some thousand regions) whatever the number of cells, but
nothing here relies on that: no row passes through the driver, and joins are left to
the planner, which broadcasts by size.
"""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.functions.scalar import ratio
from voxatlas.operators.kept import kept
from voxatlas.operators.numbering import numbered

#: Field names of the ontology JSON and their column types.
ONTOLOGY_FIELDS = {
    "id": "bigint",
    "atlas_id": "double",
    "ontology_id": "double",
    "acronym": "string",
    "name": "string",
    "color_hex_triplet": "string",
    "graph_order": "double",
    "st_level": "double",
    "hemisphere_id": "double",
    "parent_structure_id": "bigint",
}
#: The annotation columns of region tables, in their order.
ANNOTATION_COLUMNS = ["name", "acronym", "color_hex_triplet", "parent_structure_id", "parent_acronym"]
#: Ids and names of what is no region.
INVALID, UNIVERSE = -1, 0
SPECIAL_NAMES = {INVALID: "invalid", UNIVERSE: "universe"}
NO_LABEL = "no_label"
MEASURES = ["count", "volume", "sum_intensity"]
#: Rows that a task of the closure reads, and regions at most that a recursive query takes.
ROWS_PER_FILE, RECURSIVE = 1_000_000, 20_000


def flatten(texts: DataFrame) -> DataFrame:
    """Regions of ontology documents (value, each a JSON text), with their ordinal in pre-order.

    The documents are parsed as variants and walked by a recursive query, a level of the
    trees a turn; the ordinals come from the places within the trees.
    """
    spark = texts.sparkSession
    kept(texts.select(F.expr("variant_get(parse_json(value), '$.msg', 'variant')").alias("trees"))).createOrReplaceTempView("_documents")
    nodes = spark.sql(
        """with recursive nodes(node, path) as (
            select t.value, array(t.pos) from _documents, lateral variant_explode(trees) t
            union all
            select t.value, concat(nodes.path, array(t.pos)) from nodes, lateral variant_explode(variant_get(node, '$.children', 'variant')) t)
        select * from nodes"""
    )
    fields = [F.expr(f"variant_get(node, '$.{name}', '{kind}')").alias(name) for name, kind in ONTOLOGY_FIELDS.items()]
    return numbered(nodes.select(*fields, "path"), ["path"], "preorder").drop("path").withColumn("preorder", F.col("preorder").cast("int") - 1)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Flattened ontology of a JSON file; Spark reads the file, so any store will do."""
    return flatten(spark.read.text(path, wholetext=True))


def nest(regions: DataFrame) -> DataFrame:
    """(value): one JSON document with the trees that ``flatten`` came from, children in table order.

    It is put together level by level, from the leaves: each turn joins a level's regions
    with the texts of their children.
    """
    fields = F.struct(*ONTOLOGY_FIELDS)
    depths = closure(regions).groupBy("id").agg((F.count("*") - 1).cast("int").alias("depth"))
    ids = regions.select(F.col("id").alias("_p"))
    placed = regions.join(ids, F.col("parent_structure_id") == F.col("_p"), "left").withColumn("parent", F.col("_p")).drop("_p")
    nodes = kept(placed.join(depths, "id").select("id", "parent", "preorder", "depth", F.to_json(fields, {"ignoreNullFields": "false"}).alias("text")))
    deepest = nodes.agg(F.max("depth")).head()[0]
    joined = lambda rows: F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("preorder", "text"))), lambda r: r["text"]), ",")
    below = None
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = nodes.where(F.col("depth") == depth)
        inner = F.lit("")
        if below is not None:
            level = level.join(below.groupBy(F.col("parent").alias("id")).agg(joined(below).alias("children")), "id", "left")
            inner = F.coalesce("children", F.lit(""))
        below = level.select("parent", "preorder", F.concat(F.expr("left(text, length(text) - 1)"), F.lit(',"children":['), inner, F.lit("]}")).alias("text"))
    if below is None:
        return regions.sparkSession.createDataFrame([('{"msg":[]}',)], "value string")
    return below.agg(joined(below).alias("trees")).select(F.concat(F.lit('{"msg":['), "trees", F.lit("]}")).alias("value"))


def with_parents(regions: DataFrame) -> DataFrame:
    """Each region with the acronym of its parent, NULL for a root."""
    parents = regions.select(F.col("id").alias("parent_structure_id"), F.col("acronym").alias("parent_acronym"))
    return regions.join(parents, "parent_structure_id", "left").select(*regions.columns, "parent_acronym")


def with_children(regions: DataFrame, order: str = "preorder") -> DataFrame:
    """Each region with the ids of its children in table order; a leaf has none."""
    own = regions.where("parent_structure_id is not null").groupBy("parent_structure_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(order, "id"))), lambda s: s["id"]).alias("children"))
    joined = regions.join(own.withColumnRenamed("parent_structure_id", "_p"), F.col("id") == F.col("_p"), "left").drop("_p")
    return joined.withColumn("children", F.coalesce("children", F.array().cast("array<bigint>")))


def closure(regions: DataFrame) -> DataFrame:
    """(id, ancestor) for every region and each of its ancestors, itself included.

    A recursive query takes a step up the trees each turn.  Where Spark's bounds of such
    queries do not allow it, the path length doubles with every join instead.  A parent
    that is no region itself ends the path; a circle of parents is an error.
    """
    spark = regions.sparkSession
    rows = kept(regions.select("id", F.col("parent_structure_id").alias("parent")))
    most = rows.count()
    rows = rows.coalesce(1 + most // ROWS_PER_FILE)
    steps = kept(rows.join(rows.select(F.col("id").alias("parent")).distinct(), "parent", "left_semi").select("id", "parent").coalesce(1 + most // ROWS_PER_FILE))
    ids = rows.select("id").distinct()
    if most <= RECURSIVE:
        ids.createOrReplaceTempView("_ids")
        steps.createOrReplaceTempView("_steps")
        paths = spark.sql("with recursive paths(id, ancestor) as (select id, id from _ids union all select paths.id, s.parent from paths join _steps s on s.id = paths.ancestor) select id, ancestor from paths")
        try:
            return kept(paths)
        except (PySparkException, Py4JJavaError) as error:
            if "RECURSION" not in str(error):
                raise
    return _doubled(ids, steps.coalesce(1 + most // ROWS_PER_FILE), most)


def _doubled(ids: DataFrame, steps: DataFrame, most: int) -> DataFrame:
    """The closure by joins that double the path length; each turn's paths are written, and the next turn reads them."""
    jumps = steps.select("id", F.col("parent").alias("ancestor"), F.lit(1).alias("steps"))
    paths = [ids.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("steps")), jumps]
    ends = below = kept(jumps)
    length = 1
    while not ends.isEmpty():
        if length >= most:
            raise ValueError("a region is its own ancestor")
        onward = below.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next"), F.col("steps").alias("more"))
        further = kept(ends.join(onward, "ancestor").select("id", F.col("next").alias("ancestor"), (F.col("steps") + F.col("more")).alias("steps")))
        paths.append(further)
        below = below.unionByName(further)
        length *= 2
        ends = further.where(F.col("steps") == length)
    return reduce(DataFrame.unionByName, paths).select("id", "ancestor")


def rollup(measured: DataFrame, regions: DataFrame, measures: list[str]) -> DataFrame:
    """Every region's own measures plus those of all regions below it.

    The nodes are all regions and all measured ids: an id that is no region becomes a
    root without a name.  Missing measures count as 0.  Measures are added up before
    the closure join, so that no more rows than ids take part in it.
    """
    own = measured.groupBy("id").agg(*(F.sum(m).alias(m) for m in measures))
    ids = regions.select("id").union(own.select("id")).distinct()
    paths = closure(regions)
    above = own.join(paths, "id", "left").select(F.coalesce("ancestor", "id").alias("id"), *measures)
    total = above.groupBy("id").agg(*(F.sum(m).alias(m) for m in measures))
    return ids.join(total, "id", "left").join(with_parents(regions).select("id", *ANNOTATION_COLUMNS), "id", "left").select("id", *ANNOTATION_COLUMNS, *(F.coalesce(m, F.lit(0)).alias(m) for m in measures))


def with_special_names(cells: DataFrame) -> DataFrame:
    """Names of what is no region: they win over the ontology's, and no name becomes a label."""
    name = F.when(F.col("id") == INVALID, SPECIAL_NAMES[INVALID]).when(F.col("id") == UNIVERSE, SPECIAL_NAMES[UNIVERSE]).otherwise(F.coalesce("name", F.lit(NO_LABEL)))
    return cells.withColumn("name", name)


def map_ids(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells with the columns of their region, special names included."""
    return with_special_names(cells.join(regions, "id", "left"))


def group_cells(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells added up by region and over the tree, with the mean intensity per volume.

    Cells without an id (out of bounds) take no part.
    """
    own = cells.where("id is not null").groupBy("id").agg(*(F.sum(m).alias(m) for m in MEASURES))
    return rollup(own, regions, MEASURES).withColumn("iov", ratio("sum_intensity", "volume"))
