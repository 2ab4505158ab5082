"""Point sets as text, for external transformation tools, and what they give back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def point_lines(points: DataFrame, key: str = "cell_id") -> DataFrame:
    """(key, line): x y z of each point, in that order."""
    return points.select(key, F.concat_ws(" ", F.col("x").cast("string"), F.col("y").cast("string"), F.col("z").cast("string")).alias("line"))


def write_points(points: DataFrame, path: str, key: str = "cell_id") -> None:
    """A folder with a header file (``index`` and the number of points) and files of points in key order.

    The files, joined in order of their names, are the text that the tools read.
    """
    count = points.count()
    spark = points.sparkSession
    spark.createDataFrame([("index",), (str(count),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    point_lines(points, key).orderBy(key).select("line").write.mode("overwrite").text(f"{path}/points")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """(z, y, x) of the points of such a folder, or of one text file with the header in it."""
    lines = spark.read.text(path, recursiveFileLookup=True).where(F.trim("value").rlike("^\\S+\\s+\\S+\\s+\\S+$"))
    parts = F.split(F.trim("value"), "\\s+")
    return lines.select(*(parts[k].cast("double").alias(a) for a, k in (("z", 2), ("y", 1), ("x", 0))))


def parse_output_points(lines: DataFrame) -> DataFrame:
    """(point, z, y, x) of lines whose ;-separated fields have ``Point <n>`` and ``OutputPoint = [ x y z ]``."""
    inside = F.regexp_extract("value", "OutputPoint\\s*=\\s*\\[([^\\]]*)\\]", 1)
    parts = F.split(F.trim(inside), "\\s+")
    found = lines.where(F.col("value").contains("OutputPoint"))
    return found.select(F.expr("try_cast(regexp_extract(value, 'Point\\\\s+(\\\\d+)', 1) as bigint)").alias("point"), *(parts[k].cast("double").alias(a) for a, k in (("z", 2), ("y", 1), ("x", 0))))


def read_output_points(spark: SparkSession, path: str) -> DataFrame:
    """Transformed points of a file; an empty file gives no rows."""
    return parse_output_points(spark.read.text(path))
