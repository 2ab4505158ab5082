"""Many specimens in one comparison table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxatlas.operators import ontology

#: The measures of a specimen, in their order.
CELL_MEASURES = ["count", "volume", "sum_intensity", "iov"]
MASK_MEASURES = ["volume_annot", "volume_mask", "volume_prop"]
MEASURES = CELL_MEASURES + MASK_MEASURES


def specimen_table(cells_agg: DataFrame, mask: DataFrame) -> DataFrame:
    """A specimen's cell and mask measures by region: a full outer join, nothing imputed."""
    return cells_agg.select("id", *CELL_MEASURES).join(mask.select("id", *MASK_MEASURES), "id", "full")


def annotations(spark: SparkSession, regions: DataFrame) -> DataFrame:
    """Region columns of the combined table, with the two ids that are no region."""
    special = spark.createDataFrame([(i, n) for i, n in ontology.SPECIAL_NAMES.items()], "id bigint, name string")
    return ontology.with_parents(regions).select("id", *ontology.ANNOTATION_COLUMNS).unionByName(special, allowMissingColumns=True)


def combine_long(specimens: dict[str, DataFrame]) -> DataFrame:
    """(id, specimen, measure, value): one row for each measured value."""
    def long(name: str, df: DataFrame) -> DataFrame:
        return df.select("id", F.lit(name).alias("specimen"), *(F.col(m).cast("double").alias(m) for m in MEASURES)).unpivot(["id", "specimen"], MEASURES, "measure", "value").where("value is not null")

    return reduce(DataFrame.unionByName, (long(k, v) for k, v in specimens.items()))


def combine_wide(annotation: DataFrame, specimens: dict[str, DataFrame]) -> DataFrame:
    """One row for each id: the annotation columns, then <specimen>__<measure>.

    Specimens are stacked and pivoted, so that the table takes one shuffle however
    many there are; ids that only some have keep NULL for the others.
    """
    if not specimens:
        raise ValueError("no specimens")
    tagged = [df.select("id", F.lit(name).alias("_specimen"), *MEASURES) for name, df in specimens.items()]
    stacked = reduce(DataFrame.unionByName, tagged)
    wide = stacked.groupBy("id").pivot("_specimen", list(specimens)).agg(*(F.first(m).alias(f"_{m}") for m in MEASURES))
    named = wide.select("id", *(F.col(f"{s}__{m}") for s in specimens for m in MEASURES))
    return annotation.join(named, "id", "full")


def with_two_headers(wide: DataFrame) -> DataFrame:
    """A combined table as text, its first rows being the specimen and the measure of each column.

    The columns of regions belong to ``annotations``; the rest is in order of id.  A combined
    table has a row a region, so that one task puts the rows in order.
    """
    spark = wide.sparkSession
    names = [c.rsplit("__", 1) if "__" in c else ["annotations", c] for c in wide.columns if c != "id"]
    heads = [("specimen", *(n[0] for n in names)), ("measure", *(n[1] for n in names))]
    columns = [f"_{k}" for k in range(len(wide.columns))]
    top = spark.createDataFrame([(k, None, *row) for k, row in enumerate(heads)], f"_k int, _id bigint, {', '.join(f'{c} string' for c in columns)}")
    body = wide.select(F.lit(len(heads)).alias("_k"), F.col("id").alias("_id"), *(F.col(c).cast("string").alias(n) for c, n in zip(["id", *(c for c in wide.columns if c != "id")], columns, strict=True)))
    return top.unionByName(body).coalesce(1).sortWithinPartitions("_k", "_id").select(*columns)
